"""Label text as Column expressions: normalising, headers, items, signatures, HTML."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and formats as they are printed on, or misread from, the labels.
WEEKDAYS = {
    "lunes": "LUNES",
    "martes": "MARTES",
    "miercoles": "MIERCOLES",
    "miércoles": "MIERCOLES",
    "jueves": "JUEVES",
    "viernes": "VIERNES",
    "sabado": "SABADO",
    "sábado": "SABADO",
    "domingo": "DOMINGO",
}
SLOTS = {
    "DESAY": "DESAYUNO",
    "COMI": "COMIDA",
    "ALMUE": "ALMUERZO",
    "CEN": "CENA",
    "MEDIOD": "MEDIODIA",
    "NOCHE": "NOCHE",
    "AYUNA": "AYUNAS",
    "MERIEN": "MERIENDA",
}
UNITS = {
    "UG": "MCG",
    "µG": "MCG",
    "MC": "MCG",
    "MO": "MG",
    "MICROGRAMO": "MCG",
    "MICROGRAMOS": "MCG",
    "MILIGRAMO": "MG",
    "MILIGRAMOS": "MG",
}
#: The micro sign's capital is the Greek letter; both spellings of the unit mean the same.
GREEK_UNIT = {"ΜG": "MCG"}
FORM_STEMS = ("COMPRIMID", "CAPSUL", "SOBRE", "AMPOLL", "PARCHE", "BARNIZ", "GOTA", "SUPOSITORI", "INHALADOR", "PLUMA")
FORM_WORDS = ("CÁPSULA", "CÁPSULAS", "VIAL")
NOISE = ("Ø", "ø", "O", "·", "•", "■", "□", "-", "—")
FOOTERS = ("FARMACIA", "FARMAOIA", "FARMAGIA", "FARMA")
DATE = r"(\d{1,2}/\d{1,2}/\d{2,4})"
QUANTITY = r"^\s*(\d+(?:[.,]\d+)?)\b"
DOSE = r"(?iU)(\d+(?:[.,]\d+)?(?:\s*/\s*\d+(?:[.,]\d+)?)?)\s*(MG|MCG|MC|MO|UG|µG|ML|UI|G|MICROGRAMOS?|MILIGRAMOS?)\b"
COLORS = {
    "blanco": "blanco",
    "blanquecino": "blanco",
    "blancos": "blanco",
    "azul": "azul",
    "amarillo": "amarillo",
    "amarillos": "amarillo",
    "rojo": "rojo",
    "naranja": "naranja",
    "anaranjado": "naranja",
    "rosa": "rosa",
    "rosado": "rosa",
    "gris": "gris",
    "beige": "beige",
    "crema": "beige",
    "violeta": "violeta",
    "lila": "violeta",
}
SHAPES = {
    "redondo": "redondo",
    "redondos": "redondo",
    "circular": "redondo",
    "ovalado": "ovalado",
    "oval": "ovalado",
    "elipt": "ovalado",
    "alargado": "alargado",
    "alargados": "alargado",
    "oblongo": "alargado",
    "capsula": "capsula",
    "cápsula": "capsula",
    "rombo": "rombo",
}
#: Words that are no drug's name, in a reading of a single line.
STOP_WORDS = ("COMPRIMIDO", "COMPRIMIDOS", "CAPSULA", "CAPSULAS", "CÁPSULA", "CÁPSULAS", "MG", "MCG", "UG", "ML", "VIA", "ORAL")


def first_of(table: dict[str, str], text: Column) -> Column:
    """The value of the first key, in the table's order, that the text contains; else null."""
    return F.coalesce(*(F.when(F.contains(text, F.lit(k)), F.lit(v)) for k, v in table.items()))


def weekday(line: Column) -> Column:
    return first_of(WEEKDAYS, F.lower(line))


def slot(line: Column) -> Column:
    return first_of(SLOTS, F.upper(line))


def date(line: Column) -> Column:
    found = F.regexp_extract(line, DATE, 1)
    return F.when(found != "", found)


def quantity(line: Column) -> Column:
    found = F.regexp_extract(line, QUANTITY, 1)
    return F.when(found != "", F.replace(found, F.lit(","), F.lit(".")).cast("double"))


def has_dose(line: Column) -> Column:
    return line.rlike(DOSE)


def unit(text: Column) -> Column:
    """The canonical unit. The micro sign is recognised whichever its capital (parity note: upper-casing gives the Greek one)."""
    upper = F.upper(text)
    names = F.create_map(*(F.lit(x) for kv in {**UNITS, **GREEK_UNIT}.items() for x in kv))
    return F.coalesce(F.try_element_at(names, upper), upper)


def drug_name(text: Column) -> Column:
    """The words that can be a name: letters, slashes and hyphens, no marks, no dosage forms; null if none is left."""
    raw = F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda t: (t != "") & ~t.isin(*NOISE))
    bare = F.transform(raw, lambda t: F.regexp_replace(F.upper(t), r"[^A-ZÁÉÍÓÚÜÑ/\-]", ""))

    def fits(t: Column) -> Column:
        stems = reduce(lambda a, b: a | b, (F.startswith(t, F.lit(s)) for s in FORM_STEMS))
        return (F.length(t) >= 2) & ~stems & ~t.isin(*FORM_WORDS)

    kept = F.filter(bare, fits)
    return F.when(F.size(kept) > 0, F.array_join(kept, " "))


def items(line: Column) -> Column:
    """All items of a line as an array, in order: each dose with the name before it.

    The number that begins the line is the first item's quantity, and isn't searched for doses;
    a compound dose (``20/12,5``) has no single value. A line without a dose has no items.
    """
    number = F.regexp_extract(line, QUANTITY, 0)
    rest = F.substring(line, F.length(number) + 1, F.length(line))
    rest = F.when(number == "", line).otherwise(rest)
    names = F.split(rest, DOSE, -1)
    values = F.regexp_extract_all(rest, F.lit(DOSE), F.lit(1))
    units = F.regexp_extract_all(rest, F.lit(DOSE), F.lit(2))
    first = quantity(line)
    return F.transform(
        values,
        lambda v, i: F.struct(
            i.cast("int").alias("line_index"),
            F.when(i == 0, first).alias("quantity"),
            drug_name(F.get(names, i)).alias("drug_name"),
            F.when(~F.contains(v, F.lit("/")), F.try_to_number(F.replace(v, F.lit(","), F.lit(".")), F.lit("999999999.999999")).cast("double")).alias("dose_value"),
            unit(F.get(units, i)).alias("dose_unit"),
            F.trim(line).alias("raw_line"),
        ),
    )


def single_item(text: Column) -> Column:
    """A reading of one drug: the dose, and the last three words of four letters or more before it."""
    flat = F.trim(F.regexp_replace(F.upper(text), r"\s+", " "))
    pattern = r"(?U)\b(\d+(?:[.,]\d+)?)\s*(MG|G|MCG|UG|ΜG|ML)\b"
    value, dose_unit = F.regexp_extract(flat, pattern, 1), F.regexp_extract(flat, pattern, 2)
    before = F.when(value != "", F.get(F.split(flat, pattern, 2), F.lit(0))).otherwise(flat)
    words = F.transform(F.split(before, " "), lambda t: F.regexp_replace(t, "[^A-ZÁÉÍÓÚÜÑ-]", ""))
    words = F.filter(words, lambda t: (F.length(t) >= 4) & ~t.isin(*STOP_WORDS))
    last = F.slice(words, F.greatest(F.lit(1), F.size(words) - 2), F.lit(3))
    return F.struct(
        F.when(F.size(words) > 0, F.array_join(last, " ")).alias("drug_name"),
        F.when(value != "", F.replace(value, F.lit(","), F.lit(".")).cast("double")).alias("dose_value"),
        F.when(value != "", dose_unit).alias("dose_unit"),
    )


def without_accents(text: Column) -> Column:
    """Marks taken off the letters of the Latin alphabets that the labels use."""
    return F.translate(text, "ÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇáàâäãéèêëíìîïóòôöõúùûüñç", "AAAAAEEEEIIIIOOOOOUUUUNCaaaaaeeeeiiiiooooouuuunc")


def signature(dose_date: Column, dose_slot: Column) -> Column:
    """``struct(sig_date, sig_slot)``, or null if either part is missing: an incomplete header identifies nothing."""
    both = F.struct(F.trim(dose_date).alias("sig_date"), without_accents(F.upper(F.trim(dose_slot))).alias("sig_slot"))
    return F.when((dose_date != "") & (dose_slot != ""), both)


def normalized(text: Column) -> Column:
    """Line breaks as bars, white space as one space, only the characters that labels have, no bars at the ends."""
    flat = F.regexp_replace(F.regexp_replace(text, r"\n", " | "), r"\s+", " ")
    flat = F.regexp_replace(F.regexp_replace(flat, r"\s*\|\s*", " | "), r"[^0-9A-Za-zÀ-ÿ%+./()\- |]", "")
    return F.regexp_replace(flat, r"^[ |]+|[ |]+$", "")


def clean_html(text: Column) -> Column:
    """Tags as spaces, white space as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]+>", " "), r"\s+", " "))


def section(html: Column, chars: int = 600) -> Column:
    """The cleaned text between the headings of sections 3 and 4 of a leaflet."""
    found = F.regexp_extract(html, r"(?isu)3\.\s*FORMA FARMAC[ÉE]UTICA(.*?)4\.\s*DATOS CL[ÍI]NICOS", 1)
    return F.left(clean_html(found), F.lit(chars))


def keywords(text: Column, table: dict[str, str]) -> Column:
    """The distinct values of the keys that the text contains, sorted."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.array(*(F.when(F.contains(low, F.lit(k)), F.lit(v)) for k, v in table.items()))
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def is_footer(line: Column, words: tuple[str, ...] = FOOTERS) -> Column:
    upper = F.upper(line)
    return reduce(lambda a, b: a | b, (F.contains(upper, F.lit(k)) for k in words))


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def from_bags(path: Column) -> Column:
    """The part of a path from ``bags/`` on; without it the last character, as a search that fails gives -1."""
    flat = forward_slashes(path)
    at = F.instr(flat, "bags/")
    return F.when(at > 0, F.substring(flat, at, F.length(flat))).otherwise(F.right(flat, F.lit(1)))


def track_key(stem: Column, side: Column | str, kind: str, number: Column) -> Column:
    return F.format_string(f"%s:%s:{kind}%04d", stem, F.lit(side) if isinstance(side, str) else side, number)


def drug_spec(text: Column) -> Column:
    """``Name:dose:quantity`` as a struct; the quantity is a whole number of at least 1, 1 if it's missing."""
    parts = F.split(text, ":")
    n = F.coalesce(F.bround(F.get(parts, F.lit(2)).try_cast("double")).cast("int"), F.lit(1))
    return F.struct(F.trim(F.get(parts, F.lit(0))).alias("drug"), F.trim(F.get(parts, F.lit(1))).alias("dose"), F.greatest(n, F.lit(1)).alias("quantity"))


def status_label(status: Column, score: Column) -> Column:
    return (
        F.when((status == "paired") & (score >= 0.999), "verified by content").when(status == "paired", "paired by order")
        .when(status == "position_matched", "by position").when(status == "unmatched_pill", "no label")
        .when(status == "unmatched_label", "no photo").otherwise("to review")
    )


def segment_bounds(side: Column, seams: Column, height: Column) -> Column:
    """Pixel rows ``(low, high)`` of a segment: above or below one seam, or ``segment_N`` between sorted seams."""
    cuts = F.concat(F.array(F.lit(0.0)), F.array_sort(seams), F.array(F.lit(1.0)))
    number = F.when(side == "above", 0).when(side == "below", F.size(cuts) - 2).otherwise(F.regexp_extract(side, r"segment_(\d+)$", 1).try_cast("int"))
    inside = number.between(0, F.size(cuts) - 2)
    pixel = lambda i: F.floor(F.get(cuts, i) * height).cast("int")
    return F.when(inside & (F.size(seams) > 0), F.struct(pixel(number).alias("low"), pixel(number + 1).alias("high"))).otherwise(
        F.struct(F.lit(0).alias("low"), height.cast("int").alias("high"))
    )


def payload_field(payload: Column, name: str) -> Column:
    """A field of a reader's JSON, at the top or under ``res``; else null."""
    return F.coalesce(F.get_json_object(payload, f"$.{name}"), F.get_json_object(payload, f"$.res.{name}"))
