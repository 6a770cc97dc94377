"""Rows of many dimension grammars: each grammar is planned over its own rows.

The rows are written once, one folder for each grammar, and every grammar reads
its folder alone. So no row meets the staged columns of other grammars, and a
grammar that no row asks for costs nothing. The rebalance hint gives a
grammar few files and cuts one with a third of all rows into many.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import fraction_text, spell_vulgar
from ..functions.rx import as_col, lines_of, sub
from ..operators.projection import q
from ..session import fresh_dir
from .lines import map_first, map_last
from .packs import PACKS, extract_dimensions, section_field, std_label
from .reader import FIELDS

_PLACE = "__grammar"


def section_extras(text):
    """Measures of a section list that no field takes, as "Section ABBREVIATION" -> value, first ones win.

    A line is "Section | A: 1 | B: 2"; of equal sections the first line counts.
    """
    lines = F.transform(F.filter(lines_of(text), lambda x: x.contains("|")), lambda x: F.split(x, r"\s*\|\s*"))
    lines = F.transform(lines, lambda cells: F.struct(F.trim(cells[0]).alias("section"), F.slice(cells, F.lit(2), F.size(cells)).alias("cells")))
    names = F.transform(lines, lambda line: line["section"])
    firsts = F.filter(lines, lambda line, i: F.array_position(names, line["section"]) == i + 1)

    def entries(line):
        def entry(cell):
            short = F.trim(F.regexp_extract(cell, r"^([^:]*):", 1))
            return F.struct(short.alias("short"), F.trim(sub(cell, r"^[^:]*:", "")).alias("value"))

        unknown = F.filter(F.transform(line["cells"], entry), lambda e: section_field(line["section"], e["short"]).isNull() & (e["value"] != ""))
        return F.transform(unknown, lambda e: F.struct(F.trim(F.concat(line["section"], F.lit(" "), F.upper(e["short"]))).alias("key"), e["value"].alias("value")))

    return map_first(F.flatten(F.transform(firsts, entries)))


def label_extras(text):
    """Measures whose label names no field, as label without parentheses -> number, else the text; last ones win."""

    def entry(line):
        raw = F.trim(F.regexp_extract(line, r":([^:]*)$", 1))
        number = fraction_text(F.regexp_extract(spell_vulgar(raw), r"(\d+(?:\.\d+)?(?:\s+\d+/\d+)?)", 1), 3)
        label = F.trim(sub(F.regexp_extract(line, r"(?s)^(.*):[^:]*$", 1), r"\s*\(.*?\)", ""))
        return F.struct(label.alias("key"), F.coalesce(F.nullif(number, F.lit("")), raw).alias("value"))

    entries = F.transform(F.filter(lines_of(text), lambda x: x.contains(":")), entry)
    return map_last(F.filter(entries, lambda e: (e["key"] != "") & ~F.coalesce(std_label(e["key"]).isin(*FIELDS), F.lit(False))))


#: Grammars that keep what they do not know.
EXTRAS = {"BD": section_extras, "DWR": label_extras}


def route_grammars(df: DataFrame, text_col: str, pack_col: str, codes=None, out: str = "dims", extras: str = "extras") -> DataFrame:
    """Adds ``out``, the struct read by the grammar ``pack_col`` names, and ``extras``, a map of measures no field takes.

    Every row stays. One that names no grammar, or one that is not in ``codes``
    (default: all), has NULL in both. ``extras`` is NULL for grammars without
    extras and an empty map where nothing is left over; columns called ``out``
    or ``extras`` are replaced. It runs when it is called: the rows are stored
    in the shared folder.
    """
    codes = list(PACKS if codes is None else codes)
    kept = df.drop(out, extras)
    path = fresh_dir(df.sparkSession, "grammars")
    placed = kept.withColumn(_PLACE, F.when(F.col(pack_col).isin(*codes), F.col(pack_col)))
    placed.hint("rebalance", _PLACE).write.partitionBy(_PLACE).parquet(path)
    rows = df.sparkSession.read.schema(placed.schema).parquet(path)
    present = {r[0] for r in rows.select(_PLACE).distinct().collect()}

    def read_by(code):
        own = extract_dimensions(rows.where(F.col(_PLACE) == code), text_col, code, out)
        more = EXTRAS[code](as_col(text_col)) if code in EXTRAS else F.lit(None)
        return own.withColumn(extras, more.cast("map<string,string>"))

    parts = [read_by(c) for c in codes if c in present]
    kind = "struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">"
    rest = rows.where(F.col(_PLACE).isNull()).withColumns({out: F.lit(None).cast(kind), extras: F.lit(None).cast("map<string,string>")})
    whole = rest
    for part in parts:
        whole = whole.unionByName(part)
    return whole.select(*[q(c) for c in kept.columns], out, extras)
