"""Hand-checked texts, kind and text: half of each kind to learn from, half held out for calibration."""

TEXTS = (
    ("prose", "The turbine was lowered into the channel in May. Divers checked the cable the next day and found no damage."),
    ("prose", "OVERVIEW\nThe project was delayed because the permit had not been signed. Work on the quay will begin again in spring,\nwhen the weather allows the barge to leave the harbour."),
    ("prose", "A short season, but a good one: the machine ran for two hundred hours and the team learned how to service it at sea."),
    ("prose", "La turbina ha funcionado durante todo el año sin interrupciones. El equipo prepara ahora la segunda fase del proyecto."),
    ("prose", "Le câble a été posé au mois de juin et les essais ont commencé dans la baie. La suite dépend de la météo."),
    ("prose", "Die Anlage wurde im Mai in den Hafen geschleppt. Die Reparatur der Kupplung hat drei Wochen gedauert."),
    ("prose", "O dispositivo foi instalado em agosto e os primeiros resultados são bons. A equipa vai voltar ao mar na primavera."),
    ("prose", "装置は五月に設置され、順調に動いている。来年度は二号機を設置する計画である。"),
    ("prose", "The three tasks for the year were clear.\n- repair the gearbox\n- move the mooring\nAll of them were finished by October, and the crew returned to the yard with a week to spare. The report was sent to the ministry."),
    ("prose", "The berth is eighty metres deep and lies\nfour kilometres from the shore. The owner\nof the cable asked for a new survey before\nthe next device is connected to it."),
    ("list", "- Northern Basin\n- Old Harbour Tank\n- Grey Point Test Site\n- Low Water Station\n- West Quay Flume"),
    ("list", "Open points\n1. ask the owner for the year\n2. check the map of the bay\n3. add the depth to the sheet\n4. send the file back"),
    ("list", "Grey Point, pp. 3, 17\nLow Water, pp. 21\nNorthern Basin, pp. 8, 44, 91\nOld Harbour, pp. 12\nWest Quay, pp. 60, 61"),
    ("list", "Contents\nNorthern Basin ........ 3\nOld Harbour Tank ............ 9\nGrey Point ..... 14\nWest Quay Flume ........... 20"),
    ("list", "Sites by country:\nNorthern Basin; Old Harbour Tank; Grey Point Test Site; Low Water Station; West Quay Flume; Stone Bay"),
    ("list", "[x] Northern Basin done\n[ ] Old Harbour Tank no reply\n[ ] Grey Point to check\n[x] West Quay done"),
    ("list", "(a) Northern Basin;\n(b) Old Harbour Tank;\n(c) Grey Point Test Site;\n(d) Low Water Station."),
    ("list", "* the map of the bay is not in the file\n* which year is from the owner\n* a copy of the lease for the file\n* the name on the chart is another"),
    ("table", "Site\tDepth\tYear\nGrey Point\t30\t2010\nLow Water\t12\t2014\nWest Quay\t8\t2019\nStone Bay\t44\t2021"),
    ("table", "| Site | Depth | Remark |\n|---|---|---|\n| Grey Point | 30 | on the quay |\n| Low Water | 12 | to be moved |\n| West Quay | 8 | not in use |"),
    ("table", "Year,Site,Capacity\n2010,Grey Point,50 kW\n2014,Low Water,n/a\n2019,West Quay,1 MW\n2021,Stone Bay,75 kW"),
    ("table", "Site          Depth   Year\nGrey Point    30      2010\nLow Water     12      2014\nWest Quay     8       2019\nStone Bay     44      2021"),
    ("table", "+-------+-------+\n| Depth | Year  |\n| 30    | 2010  |\n| 12    | 2014  |\n| 8     | 2019  |\n+-------+-------+"),
    ("table", "Site;Status;Depth\nGrey Point;planned;30\nLow Water;suspended;12\nWest Quay;in testing;8\nStone Bay;planned;44"),
    ("junk", "Accept all cookies. Accept all cookies. Accept all cookies. Accept all cookies. Accept all cookies. Accept all cookies. Accept all cookies."),
    ("junk", "page not found\npage not found\npage not found\npage not found\npage not found\npage not found"),
    ("junk", "\\pard \\fs24 \\cf1 \\'92 \\tab \\f0 {\\*\\fldinst } \\par \\pard \\f0 \\fs24 \\cf1 \\tab \\'92 \\'92 \\par"),
    ("junk", "<td></td>\n<br/>&nbsp;\n</div></div>\n<span class=\"a\"></span>\n{{ }}\n<td></td>\n&nbsp;&nbsp;\n</div>"),
    ("junk", "Ã¢â€™Â½Ã¢Â¬Ã±â€ Â½ï¿½Ã¢ÂÃâ€™Ã±Ã½ÂÃ¢â€ Ã½ï¿½Â¬Ã±Ã¢Ââ€™Ã±Ã½ÂÃ¢â€"),
    ("junk", "l1|;' .,~^ I!_ *n;: r'|l -,.^ ;I1! _~| n'l: .;^- !|I' ,*_ r~; l|'.^ :;-, ~I!n |'_ ;.l*"),
    ("junk", "9f3a77b1c0de44e29a1b5577c3de0f9a11b2c3d4e5f60718293a4b5c6d7e8f9012ab34cd56ef78"),
    ("junk", "hTe cerw fo hte raBeg edkas rof a wen nohcar ta het nde fo eth asesno nad ti saw ton rayde"),
    ("junk", "asdf jkl; qwer asdf zxcv poiu lkj asdf ;lkj fdsa qwerqwer asdf jkl; zxcv asdf poiu qwe asd fgh jkl"),
)

_BY_KIND = [[x for x in TEXTS if x[0] == kind] for kind in dict.fromkeys(k for k, _ in TEXTS)]
SEEDS = tuple(x for texts in _BY_KIND for x in texts[0::2])
HOLDOUT = tuple(x for texts in _BY_KIND for x in texts[1::2])
