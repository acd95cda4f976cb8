"""Units as people write them: which unit a text names, and how to convert from it.

The tables below are fixed values (spellings after normalisation, conversion factors), stated plainly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values. Unit code -> spellings after normalise(). Temperatures of tas.
TEMPERATURE = {
    "K": ["k", "kelvin", "kelvins", "degk", "deg k", "degree k", "degrees k", "°k", "degree kelvin", "degrees kelvin", "absolute temperature kelvins", "absolute temperature", "grad kelvin"],
    "degC": ["c", "degc", "deg c", "°c", "° c", "℃", "celsius", "degree c", "degrees c", "degree celsius", "degrees celsius", "centigrade", "degrees centigrade", "grad celsius"],
    "degF": ["f", "degf", "deg f", "°f", "° f", "℉", "fahrenheit", "degree f", "degrees f", "degree fahrenheit", "degrees fahrenheit", "fahrenheit scale", "grad fahrenheit"],
}
#: Fixed values. Precipitation of pr: rates first, then amounts over a step.
PRECIPITATION = {
    "mm/h": ["mm/h", "mm h-1", "mm h^-1", "mm/hr", "mm hr-1", "mm/hour", "mm hour-1", "mmh-1", "mm per hour", "millimetre per hour", "millimetres per hour", "millimeters per hour", "millimeter pro stunde"],
    "mm/day": ["mm/d", "mm d-1", "mm/day", "mm day-1", "mm per day", "millimetre per day", "millimetres per day", "millimeters per day", "millimeter pro tag"],
    "mm/s": ["mm/s", "mm s-1", "mm per second", "millimetres per second", "kg m-2 s-1", "kg/m2/s", "kg/m2 s", "kg/(m2 s)", "kg m-2/s", "kilograms per square metre per second", "kilogram per square metre per second"],
    "cm/day": ["cm/d", "cm d-1", "cm/day", "cm day-1", "cm per day", "centimetres per day", "zentimeter pro tag"],
    "cm/h": ["cm/h", "cm h-1", "cm/hr", "cm hour-1", "centimetres per hour"],
    "m/s": ["m/s", "m s-1", "metres per second"],
    "m/day": ["m/d", "m d-1", "m/day", "m day-1", "metres per day"],
    "m/h": ["m/h", "m h-1", "metres per hour"],
    "in/h": ["in/h", "in h-1", "inch/hour", "inch/h", "inch hour-1", "inches/hour", "in/hr", "in hr-1", "inch per hour", "inches per hour"],
    "in/day": ["in/d", "in d-1", "in/day", "in day-1", "inch/day", "inch per day", "inches per day"],
    "mm": ["mm", "millimetre", "millimetres", "millimeter", "millimeters", "kg m-2", "kg/m2", "mm of water equivalent", "millimetres accumulated over the step", "total of the step in mm", "kilograms per square metre"],
    "cm": ["cm", "centimetre", "centimetres", "cm of water equivalent", "centimetres accumulated over the step", "total of the step in cm"],
    "m": ["m", "metre", "metres", "meter", "meters", "m of water equivalent", "metres accumulated over the step", "total of the step in m"],
    "in": ["in", "inch", "inches", "inches accumulated over the step", "total of the step in inches"],
}
#: Size of a unit in K, and what to add; size of a rate in mm h-1; size of an amount in mm.
TO_KELVIN = {"K": (1.0, 0.0), "degC": (1.0, 273.15), "degF": (5.0 / 9.0, 459.67 * 5.0 / 9.0)}
RATE_MMH = {"mm/h": 1.0, "mm/day": 1 / 24, "mm/s": 3600.0, "cm/day": 10 / 24, "cm/h": 10.0, "m/s": 3.6e6, "m/day": 1000 / 24, "m/h": 1000.0, "in/h": 25.4, "in/day": 25.4 / 24}
AMOUNT_MM = {"mm": 1.0, "cm": 10.0, "m": 1000.0, "in": 25.4}
#: Words for a fraction, and prefixes of kelvin.
FRACTION_WORDS = {"tenths of": 0.1, "tenth of": 0.1, "hundredths of": 0.01, "hundredth of": 0.01, "thousandths of": 0.001}
KELVIN_PREFIX = {"dk": 0.1, "ck": 0.01, "mk": 0.001}
#: Texts that stand in for a unit without naming one.
NO_UNIT = ["", "-", "--", "?", "unknown", "see note", "none", "null", "nan", "n/a", "na", "unit", "units", "various", "tbd"]


def normalise(text: Column) -> Column:
    """Small letters, plain exponents, single blanks, no brackets: 'kg·m⁻²·s⁻¹' and 'kg m**-2 s**-1' both become 'kg m-2 s-1'."""
    t = F.lower(F.translate(text, "⁻⁰¹²³−·× _,", "-0123- x   "))
    t = F.regexp_replace(t, r"\*\*|\^(?=-)", "")
    t = F.regexp_replace(t, r"^\s*(?:in\s+(?=\d|1/)|in\s+(?=kelvin|degree|celsius|fahrenheit|hundredth|tenth|mm\b|milli|centi|metre))", "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[\[\]()]", " "), r"\s+", " "))


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _spelled(table: dict[str, list[str]]) -> Column:
    return _map({s: code for code, spellings in table.items() for s in spellings})


def bind(value: Column, use) -> Column:
    """use(value), with value worked out once however often use names it."""
    return F.transform(F.array(value), use)[0]


def named_unit(text: Column, var: Column) -> Column:
    """struct(code, factor) of the unit that a text names for tas or pr; null if it names none.

    factor is the fraction whose multiples the value counts: 0.1 in '0.1 degC', '1/10 °C', 'degC/10' and
    'tenths of a degree Celsius'.
    """
    word = r"^((?:tenth|hundredth|thousandth)s? of)(?: an?)? (.+)$"
    head = r"^(?:x )?(\d+(?:\.\d+)?)(?:/(\d+))? (?:x )?(\D.*)$"
    tail = r"^(k|c|f|°[cf]|℃|deg ?[kcf]|kelvin|celsius|fahrenheit) ?/ ?(\d+)$"

    def parts(t: Column) -> Column:
        whole = F.struct(t.alias("bare"), F.lit(1.0).alias("factor"))
        over = lambda x, y: F.try_divide(x.try_cast("double"), F.coalesce(F.nullif(y, F.lit("")).try_cast("double"), F.lit(1.0)))
        return (
            F.when(t.rlike(word), F.struct(F.regexp_extract(t, word, 2).alias("bare"), _map(FRACTION_WORDS)[F.regexp_extract(t, word, 1)].alias("factor")))
            .when(t.rlike(head), F.struct(F.regexp_extract(t, head, 3).alias("bare"), over(F.regexp_extract(t, head, 1), F.regexp_extract(t, head, 2)).alias("factor")))
            .when(t.rlike(tail), F.struct(F.regexp_extract(t, tail, 1).alias("bare"), over(F.lit("1"), F.regexp_extract(t, tail, 2)).alias("factor")))
            .when(t.isin(*KELVIN_PREFIX), F.struct(F.lit("k").alias("bare"), _map(KELVIN_PREFIX)[t].alias("factor")))
            .otherwise(whole)
        )

    def unit(p: Column) -> Column:
        code = F.when(var == "tas", _spelled(TEMPERATURE)[p["bare"]]).when(var == "pr", _spelled(PRECIPITATION)[p["bare"]])
        return F.struct(code.alias("code"), p["factor"].alias("factor"))

    found = bind(bind(bind(normalise(text), parts), unit), lambda u: F.when(u["code"].isNotNull() & (u["factor"] > 0), u))
    return F.when(text.isNotNull() & (text != ""), found)


def first_unit(texts: list[tuple[str, Column, bool]], var: Column) -> Column:
    """struct(code, factor, source, unread) of the first text that names a unit; later texts are not looked at.

    texts: source, text, and whether the text stands where only a unit should. If such a text is neither a unit nor one
    of NO_UNIT, the search ends there without a unit, and unread is set.
    """
    start = F.lit(None).cast("struct<code:string,factor:double,source:string,unread:boolean>")

    def step(acc: Column, x: Column) -> Column:
        blank = ~x["only"] | F.trim(F.lower(x["text"])).isin(*NO_UNIT)
        found = bind(
            named_unit(x["text"], var),
            lambda u: F.when(u.isNotNull(), F.struct(u["code"].alias("code"), u["factor"].alias("factor"), x["source"].alias("source"), F.lit(False).alias("unread"))).when(
                ~blank, F.struct(F.lit(None).cast("string").alias("code"), F.lit(None).cast("double").alias("factor"), F.lit(None).cast("string").alias("source"), F.lit(True).alias("unread"))
            ),
        )
        return F.coalesce(acc, F.when(x["text"].isNotNull(), found))

    rows = F.array(*[F.struct(F.lit(s).alias("source"), t.alias("text"), F.lit(only).alias("only")) for s, t, only in texts])
    return F.aggregate(rows, start, step)


#: Phrases that name a unit inside a description; the description itself may hold other words and numbers.
_PHRASES = (
    r"\(\s*(?:K|°C|°F|℃|[mc]?m(?:/|\s)[hds]\w*(?:-1)?|kg[^)]*|mm[^)]*|in/h|deg ?[KCF])\s*\)",
    r"(?:in\s+)?\b(?:tenth|hundredth|thousandth)s? of (?:a )?(?:degrees? )?(?:kelvin|celsius|fahrenheit)",
    r"in\s+(?:\d\.\d+|1/\d+)\s*(?:°C|K|degC|°F)",
    r"absolute temperature,? kelvins?",
    r"(?:in\s+)?(?:degrees? |grad )?(?:kelvins?|celsius|centigrade|fahrenheit(?: scale)?)\b",
    r"\b(?:milli|centi)?(?:metres?|meters?) (?:per (?:hour|day|second)|accumulated over the step)",
    r"\binch(?:es)? (?:per (?:hour|day)|accumulated over the step)",
    r"\bkilograms? per square metre per second",
    r"\btotal of the step in (?:mm|cm|m|inches)\b",
    r"\b(?:milli|zenti)meter pro (?:tag|stunde)",
)


def unit_phrase(note: Column) -> Column:
    """The part of a note that names the unit, '' if none does. What follows a semicolon speaks of other files and years."""
    head = F.split_part(F.translate(note, " ", " "), F.lit(";"), F.lit(1))
    return F.regexp_extract(head, "(?iu)(" + "|".join(_PHRASES) + ")", 1)


def written_number(text: Column) -> Column:
    """The number that a text begins with (decimal point or comma, any minus sign), as double; null if none."""
    plain = F.translate(F.trim(F.translate(text, " −", " -")), ",", ".")
    return F.nullif(F.regexp_extract(plain, r"^([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)", 1), F.lit("")).try_cast("double")


def written_unit(text: Column) -> Column:
    """What follows the number that a text begins with."""
    return F.regexp_extract(F.translate(text, " −", " -"), r"^\s*[+-]?\d+(?:[.,]\d+)?(?:[eE][+-]?\d+)?\s*(.*?)\s*$", 1)


def canonical_value(value: Column, code: Column, factor: Column, step_hours: Column) -> Column:
    """A value in K (temperatures) or mm h-1 (rates, and amounts over step_hours); null if it cannot be worked out."""
    x = value * factor
    look = lambda d: _map(d)[code]
    kelvin = x * look({k: v[0] for k, v in TO_KELVIN.items()}) + look({k: v[1] for k, v in TO_KELVIN.items()})
    step = F.when(step_hours > 0, step_hours)
    return F.coalesce(kelvin, x * look(RATE_MMH), x * look(AMOUNT_MM) / step)
