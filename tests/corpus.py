"""A seeded corpus of text pages with a known outcome."""

from datetime import date, timedelta

BASE = date(2024, 1, 1)
SURNAMES = ["Tarfolde", "Quemuzzi", "Bradolmo", "Vistrelli", "Norpache", "Lugrante", "Zimbarro", "Fendoguía"]
GIVEN = ["Ana", "Bruno", "Carla", "Darío", "Elena", "Fabián", "Gisela"]


def person(i):
    """Name, national id and birth date of patient ``i``; no two share all of them."""
    name = f"{SURNAMES[i % 8]}{'abcdefghij'[i // 8 % 10]}{'lmnopqrstu'[i // 80 % 10]}, {GIVEN[i % 7]}"
    return name, 20_000_000 + 37 * i, date(1950, 1, 1) + timedelta(days=13 * i)


def laboratory(i, day, n=0):
    name, dni, born = person(i)
    return (
        f"Apellido y Nombre: {name}\nDNI: {dni}\nF.Nacimiento: {born:%d/%m/%Y}\nMédico derivante: Ruiz, Pedro\nNº Petición: {1000 + i}{n}\n"
        f"Fecha: {day:%d/%m/%Y}\nHora de Extracción: 08:30\nHEMATOLOGIA\nHemoglobina | 13,{i % 10} | g/dL | 12 - 16\nQUIMICA CLINICA\nUrea  {30 + i % 9}  mg/dL  10 - 50\n"
    )


def ecg(i, day, n=0):
    name, _, born = person(i)
    months = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
    us = lambda d: f"{d:%d}-{months[d.month - 1]}-{d:%Y}"
    return f"{name}~,  ID:{i}{n}  {us(day)}  10:11:12   Hospital\n{us(born)} (50 yr) Male\nTechnician: T\nOrdered by: - Ruiz, Pedro\n{60 + i % 30}\nVent. rate\nbpm\nMORTARA\n"


def echo(i, day, n=0):
    name, dni, _ = person(i)
    return (
        f"SERVICIO DE ECOCARDIOGRAFIA\nPaciente: {name}\nDocumento: {dni}\nNº Estudio: {i}{n}\nFecha Estudio: {day:%d/%m/%Y}\nMédico Solicitante: Ruiz, Pedro\n"
        f"MEDIDAS\nAO | {30 + i % 7} | mm\nCONCLUSIONES\nEstudio de {name}, documento {dni}, normal. Copia a Pedro Ruiz.\nFirma: Gómez, Luis - MP 123{n}\n"
    )


def corpus(whole, limit, split, missing, ambiguous, corrupt, copies):
    """Rows (documento, pages) and the patients' literals; one case per patient."""
    rows, literals, i = [], [], 0

    def add(kind, page):
        rows.append((f"{len(rows):05d}-{kind}.pdf", [page] if page is not None else []))

    def case(days, kinds=(laboratory, ecg, echo), extra=()):
        nonlocal i
        start = BASE + timedelta(days=20 * (i % 90))
        for make, shift in zip(kinds, days):
            add(make.__name__, make(i, start + timedelta(days=shift)))
        for make in extra:
            add(make.__name__, make(i, start, 7))
        name, dni, _ = person(i)
        literals.extend([name, str(dni), name.split(",")[0]])
        i += 1

    for _ in range(whole):
        case((0, 1, 2))
    for _ in range(limit):
        case((0, 7, 6))
    for _ in range(split):
        case((0, 7, 8))
    for _ in range(missing):
        case((0, 1), (laboratory, ecg))
    for _ in range(ambiguous):
        case((0, 1, 2), extra=(echo,))
    for _ in range(corrupt):
        case((0, 1), (laboratory, ecg))
        add("echo", None)
    for name, pages in rows[:copies]:
        rows.append((f"z-copia-{name}", pages))
    return rows, literals
