"""Sources mixed to target shares of tokens, small sources repeated at most a capped number of times.

Documents are aggregated by membership pattern (the set of sources they may stand for). A min-cost flow routes each pattern's
tokens to the sources' quotas; using a pattern once more costs more each time, so repetition is spread and kept low. Each
pattern's flows are then laid one after another on a line along which its documents, in a seeded random order, come round
again and again; a document is used as often as its place falls into a source's stretch.
"""

from __future__ import annotations

from collections import defaultdict, deque
from fractions import Fraction
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Row, functions as F, Window

from ..session import cut_lineage

BUCKETS = 4096
MAX_PATTERNS = 4096


def min_cost_flow(arcs: list[tuple[str, str, int, int]], source: str, sink: str) -> tuple[int, list[int]]:
    """The largest flow of least cost: its size and the flow on each of ``arcs`` (from, to, capacity, cost)."""
    to, cap, cost, at = [], [], [], defaultdict(list)
    for a, b, c, w in arcs:
        for u, v, k, p in ((a, b, c, w), (b, a, 0, -w)):
            at[u].append(len(to))
            to.append(v)
            cap.append(k)
            cost.append(p)
    total = 0
    while True:
        far, via, queue, waits = {source: 0}, {}, deque([source]), {source}
        while queue:  # shortest path with negative costs on the way back
            u = queue.popleft()
            waits.discard(u)
            for e in at[u]:
                if cap[e] > 0 and far[u] + cost[e] < far.get(to[e], 1 << 60):
                    far[to[e]], via[to[e]] = far[u] + cost[e], e
                    if to[e] not in waits:
                        waits.add(to[e])
                        queue.append(to[e])
        if sink not in far:
            return total, [cap[2 * i + 1] for i in range(len(arcs))]
        v, most = sink, 1 << 62
        while v != source:
            e = via[v]
            most, v = min(most, cap[e]), to[e ^ 1]
        v = sink
        while v != source:
            e = via[v]
            cap[e] -= most
            cap[e ^ 1] += most
            v = to[e ^ 1]
        total += most


def min_cost_flow_by_levels(arcs: list[tuple[str, str, int, int]], source: str, sink: str) -> tuple[int, list[int]]:
    """As ``min_cost_flow``, with as many rounds as there are different costs of a path, for graphs of many arcs.

    All paths of the least cost are filled at once, by blocking flows over the arcs that lie on one; costs must not be negative.
    """
    node: dict[str, int] = {}
    to, cap, cost, at = [], [], [], []
    for a, b, c, w in arcs:
        for u, v, k, p in ((a, b, c, w), (b, a, 0, -w)):
            for x in (u, v):
                if x not in node:
                    node[x] = len(node)
                    at.append([])
            at[node[u]].append(len(to))
            to.append(node[v])
            cap.append(k)
            cost.append(p)
    if source not in node or sink not in node:
        return 0, [0] * len(arcs)
    s, t, total = node[source], node[sink], 0
    pot = [0] * len(node)
    while True:
        # what a path costs beyond the potentials, none below 0
        far, heap = {s: 0}, [(0, s)]
        while heap:
            d, u = heappop(heap)
            if d > far[u]:
                continue
            for e in at[u]:
                v = to[e]
                if cap[e] > 0 and (x := d + cost[e] + pot[u] - pot[v]) < far.get(v, 1 << 60):
                    far[v] = x
                    heappush(heap, (x, v))
        if t not in far:
            return total, [cap[2 * i + 1] for i in range(len(arcs))]
        for u in range(len(pot)):
            pot[u] += min(far.get(u, far[t]), far[t])
        while True:  # the largest flow over arcs without a cost of their own: levels, then a blocking flow
            level, waits = {s: 0}, deque([s])
            while waits:
                u = waits.popleft()
                for e in at[u]:
                    if cap[e] > 0 and to[e] not in level and cost[e] + pot[u] - pot[to[e]] == 0:
                        level[to[e]] = level[u] + 1
                        waits.append(to[e])
            if t not in level:
                break
            tried, path, u = [0] * len(at), [], s
            while True:
                if u == t:
                    most = min(cap[e] for e in path)
                    total += most
                    for e in path:
                        cap[e] -= most
                        cap[e ^ 1] += most
                    cut = next(i for i, e in enumerate(path) if cap[e] == 0)
                    u = to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while tried[u] < len(at[u]):
                    e = at[u][tried[u]]
                    if cap[e] > 0 and level.get(to[e], -1) == level[u] + 1 and cost[e] + pot[u] - pot[to[e]] == 0:
                        break
                    tried[u] += 1
                else:
                    if not path:
                        break
                    u = to[path.pop() ^ 1]
                    tried[u] += 1
                    continue
                path.append(e)
                u = to[e]


def plan(patterns: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens each pattern gives to each source. ``targets``: share and cap by source; ``total``: tokens wanted.

    Without ``total`` (or with more than can be had) the mixture is the largest whose shares can be met.
    """
    share = {s: Fraction(t).limit_denominator(10**9) for s, (t, _) in targets.items() if t > 0}
    norm = sum(share.values()) or 1
    share = {s: t / norm for s, t in share.items()}

    def flow(size: int) -> tuple[int, list, list[int]]:
        arcs, kept = [], []
        for i, (p, tokens) in enumerate(patterns.items()):
            own = [s for s in p if s in share and targets[s][1] > 0]
            if not own or tokens <= 0:
                continue
            for r in range(max(targets[s][1] for s in own) if len(own) == 1 else sum(targets[s][1] for s in own)):
                arcs.append(("S", f"p{i}", tokens, r))
                kept.append(None)
            for s in own:
                arcs.append((f"p{i}", f"s{s}", tokens * targets[s][1], 0))
                kept.append((p, s))
        for s, t in share.items():
            arcs.append((f"s{s}", "T", int(t * size), 0))
            kept.append(None)
        size_got, on = (min_cost_flow if len(patterns) <= MAX_PATTERNS else min_cost_flow_by_levels)(arcs, "S", "T")
        return size_got, kept, on

    def met(size: int) -> bool:
        return flow(size)[0] >= sum(int(t * size) for t in share.values())

    low, high = 0, sum(n * max((targets[s][1] for s in p if s in share), default=0) * max(1, len(p)) for p, n in patterns.items())
    if total is not None and met(min(total, high)):
        low = min(total, high)
    else:
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if met(mid) else (low, mid - 1)
    _, kept, on = flow(low)
    return {k: f for k, f in zip(kept, on) if k is not None and f > 0}


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 1) -> DataFrame:
    """The mixture: ``doc_id``, ``source`` it stands for, ``n_tokens`` and ``repeats`` (how often it is used).

    ``docs`` has ``doc_id``, ``memberships`` (array of sources) and ``n_tokens``; ``targets`` has ``source``,
    ``target_share``, ``max_repeats`` (a small table of sources). Documents without tokens or without a target source are
    not used. Of more than ``MAX_PATTERNS`` sets of sources the flow is found by levels of cost, at no loss. Each source's tokens differ from its quota by less than one document.
    """
    spark = docs.sparkSession
    wanted = {r["source"]: (float(r["target_share"]), int(r["max_repeats"] or 0)) for r in targets.where("source is not null and target_share > 0").select("source", "target_share", "max_repeats").collect()}
    known = F.array(*[F.lit(s) for s in sorted(wanted)]).cast("array<string>")
    rows = docs.select("doc_id", "n_tokens", F.array_join(F.array_sort(F.array_intersect("memberships", known)), "\x1f").alias("pattern")).where("n_tokens > 0 and pattern != ''")
    order = F.xxhash64("doc_id", F.lit(seed))
    rows = cut_lineage(rows.withColumns({"order": order, "bucket": F.shiftrightunsigned(order, 52).cast("int")}))
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("n"))
    # a running sum over at most BUCKETS rows a pattern, in tasks
    place = sums.withColumn("offset", F.coalesce(F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    most = sums.groupBy("pattern").agg(F.sum("n").alias("n"))
    totals = {r["pattern"]: r["n"] for r in most.orderBy("pattern").collect()}  # a row a pattern
    flows = plan({tuple(p.split("\x1f")): n for p, n in totals.items()}, wanted, total)
    stretches: dict[str, list[tuple[str, int, int]]] = defaultdict(list)
    for (p, s), n in sorted(flows.items()):
        key = "\x1f".join(p)
        start = stretches[key][-1][2] if stretches[key] else 0
        stretches[key].append((s, start, start + n))
    schema = "doc_id bigint, source string, n_tokens bigint, repeats bigint"
    if not stretches:
        return spark.createDataFrame([], schema)
    running = F.sum("n_tokens").over(Window.partitionBy("pattern", "bucket").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("x", F.coalesce(running, F.lit(0))).join(place, ["pattern", "bucket"]).withColumn("x", F.col("x") + F.col("offset"))
    plans = spark.createDataFrame([Row(pattern=p, source=s, a=a, b=b, size=totals[p]) for p, x in stretches.items() for s, a, b in x], "pattern string, source string, a bigint, b bigint, size bigint")
    before: Column = lambda end: F.floor((F.col(end) - 1 - F.col("x")) / F.col("size"))
    used = placed.join(F.broadcast(plans) if len(stretches) <= MAX_PATTERNS else plans, "pattern").withColumn("repeats", (before("b") - before("a")).cast("bigint"))
    return used.where("repeats > 0").select("doc_id", "source", F.col("n_tokens").cast("bigint").alias("n_tokens"), "repeats")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """Reached against wanted: ``source``, ``target_share``, ``actual_share``, ``tokens``, ``n_documents``, ``most_repeats``."""
    per = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("n_documents"), F.max("repeats").alias("most_repeats"))
    whole = per.agg(F.sum("tokens").alias("whole"))
    out = targets.select("source", "target_share").where("source is not null").join(per, "source", "left").crossJoin(whole)  # one row
    return out.select("source", "target_share", (F.coalesce("tokens", F.lit(0)) / F.col("whole")).alias("actual_share"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("tokens", "n_documents", "most_repeats")])
