"""Small drop files in the shapes of the real feeds."""

import os

DATES = ["21.02.2023", "22.02.2023"]


def write(folder, name, text, encoding="utf-8"):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def block(inv, pac, daysum, status="6", error="0"):
    return ";".join([inv, pac, daysum, status, error, "1", "2", "300", "301", "25", "230"])


def inverter_file(folder, name="min230221.csv", date="21.02.23"):
    head = "Date;Time;" + ";".join(["INV;Pac;DaySum;Status;Error;Pdc1;Pdc2;Udc1;Udc2;Temp;Uac"] * 2)
    lines = [
        head,
        f"{date};10:00:00;{block('1', '6000', '100')};{block('2', '3000', '50', '7', '2')}",
        f"{date};10:05:00;{block('1', '12000', '110')};2;2500",
        f"{date};10:05:00;{block('1', '99999', '999')};{block('2', '9', '9')}",
        f"99.99.23;10:10:00;{block('1', '1', '1')};{block('2', '1', '1')}",
        f"{date};26:00:00;{block('1', '1', '1')};{block('2', '1', '1')}",
        f"{date};10:15:00;{block('', '600', 'n/a', '', 'x')};{block('2', 'bad', '60')}",
        f"{date};10:20:30;{block('1', '', '120')};{block('2', '1200', '70')}",
    ]
    return write(folder, name, "\n".join(lines) + "\n")


def meter_file(folder, date, kind, values, short_year=False):
    """values: {time: value text}; a repeated time is a list of texts."""
    day = date[:-4] + date[-2:] if short_year else date
    lines = ['"Date";"Heure";"Unité";"Valeur";"Valeur Acquisition"']
    for time, texts in values.items():
        for t in texts if isinstance(texts, list) else [texts]:
            lines.append(f'"{day}";"{time}";"kWh";"{t}";"x"')
    return write(folder, f"{date}-{kind}.csv", "\n".join(lines) + "\n", "iso-8859-1")


def meter_files(folder):
    for d in DATES:
        hours = {f"{h}:00:00": str(10 + h) for h in range(24)}
        meter_file(folder, d, "Consumption", {**hours, "7:00:00": ["17", "99"], "12:99:00": "1"}, short_year=d == DATES[0])
        meter_file(folder, d, "Temperature", {k: str(float(v) / 2) for k, v in hours.items() if k != "3:00:00"})
        meter_file(folder, d, "Humidity", hours)
        meter_file(folder, d, "PV", {"10:00:00": "1.5", "10:05:00": "2.5"})
    meter_file(folder, "23.02.2023", "Consumption", {"1:00:00": "5"})   # no partner files


BOOKING_HEAD = ["Date", "Date de début", "Date de fin", "Nom", "Type de réservation", "Codes", "Nom de l'utilisateur",
                "Classe", "Activité", "Professeur", "Division", "Remarque"]


def booking_row(date, start, end, room, user, classes, professors, code="C", activity="Cours", division="Énergie"):
    return [date, start, end, room, "Leçon", code, user, classes, activity, professors, division, "-"]


def booking_file(folder, name, rows, head=BOOKING_HEAD):
    lines = ["\t".join(f'"{c}"' for c in r) for r in [head, *rows]]
    return write(folder, name, "\n".join(lines) + "\n")


FIRST_BOOKINGS = [
    booking_row("21 févr. 2023", "08:00", "10:00", "VS-BEL.N101", "Ann", "A1, A2", "Prof X,Prof Y"),
    booking_row("21 févr. 2023", "08:30", "11:00", "VS-BEL.N102", "", "none", "Prof X", code=""),
    booking_row("21 févr. 2023", "09:00", "10:00", "VS-OTH.1", "Bob", "A1", "Prof X"),
    booking_row("22 févr. 2023", "13:00", "17:00", "VS-BEL.N101", "ANN", "B1", "Prof Z", activity="Réunion"),
    booking_row("22 févr. 2023", "07:30", "08:00", "VS-BEL.N103", "Cid", "B1", "Prof Z", division="Santé"),
    booking_row("22 févr. 2023", "10:00", "12:00", "VS-BEL.N103", "Cid", " , ", "Prof Z"),
    booking_row("31 févr. 2023", "10:00", "12:00", "VS-BEL.N103", "Cid", "B1", "Prof Z"),
]
SECOND_BOOKINGS = [
    FIRST_BOOKINGS[0],
    booking_row("22 févr. 2023", "13:00", "17:00", "VS-BEL.N101", "ANN", "B1", "Prof Z", activity="Réunion"),
    booking_row("21 févr. 2023", "15:00", "16:00", "VS-BEL.N104", "Dee", "C1", "Prof W"),
]


def meteo_file(folder, name="Pred_2023-02-21.csv", days=("2023-02-21", "2023-02-22")):
    lines = ["Time,Site,Prediction,Measurement,Value"]
    for d in days:
        for h in range(0, 24):
            for site in ("Sion", "Visp", "Bern"):
                for p in (1, 2):
                    for i, m in enumerate(("PRED_T_2M_ctrl", "PRED_RELHUM_2M_ctrl", "PRED_TOT_PREC_ctrl", "PRED_GLOB_ctrl")):
                        value = -99999.0 if (m.startswith("PRED_TOT") and h == 4) else h + i * 10 + p / 10
                        lines.append(f"{d} {h:02d}:00:00,{site},{p},{m},{value}")
    lines.insert(1, f"{days[0]} 00:00:00,Sion,1,PRED_T_2M_ctrl,")          # first value missing
    lines.append(f"{days[0]} 00:00:00,Sion,1,PRED_T_2M_ctrl,777")            # late duplicate
    lines.append(f"{days[0]} 00:00:00,Sion,1,PRED_T_2M_ctrl,1,2,3")          # malformed line
    lines.append(f"{days[0]} 00:00:00,Sion,9,PRED_T_2M_ctrl,5")              # three measures missing
    return write(folder, name, "\n".join(lines) + "\n")
