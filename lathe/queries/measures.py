"""Measures of each part, written in a notation and read back by its grammar.

The oracle never parses text: it computes the numbers the text was made of.
"""

import re

from pyspark.sql import functions as F

from ..functions.numbers import fraction_value
from ..spec.packs import PACKS, extract_dimensions
from ..spec.reader import FIELDS
from .registry import query, texts

# name: (whole part, quarters or None) as SQL both engines read.
NUMBERS = {
    "w": ("p_size + 10", "p_partkey % 4"),
    "d": ("p_size % 7 + 20", "(p_partkey + 1) % 4"),
    "h": ("p_partkey % 50 + 30", "(p_partkey + 2) % 4"),
    "l": ("p_size + 60", "(p_partkey + 3) % 4"),
    "o": ("p_size + 5", "p_size % 4"),
    "wt": ("p_partkey % 90 + 10", None),
    "sh": ("p_size % 5 + 15", None),
    "sd": ("p_size % 4 + 18", None),
    "sw": ("p_size % 3 + 19", None),
    "ah": ("p_size % 6 + 22", None),
    "aw": ("p_size % 5 + 3", None),
}


def shown(name: str) -> str:
    """SQL for a number's text: decimal point form, ``f``-suffixed names as "w n/d"."""
    fraction = name.endswith("f") and name[:-1] in NUMBERS
    whole, quarter = NUMBERS[name[:-1] if fraction else name]
    text = f"cast({whole} as string)"
    if quarter is None:
        return text
    forms = ("' 1/4'", "' 1/2'", "' 3/4'") if fraction else ("'.25'", "'.5'", "'.75'")
    return f"concat({text}, case {quarter} when 1 then {forms[0]} when 2 then {forms[1]} when 3 then {forms[2]} else '' end)"


def value(name: str) -> str:
    whole, quarter = NUMBERS[name]
    return f"cast({whole}{'' if quarter is None else f' + ({quarter}) * 0.25'} as double)"


def text_column(template: str):
    pieces = re.split(r"\{(\w+)\}", template)
    cols = [F.lit(p) if i % 2 == 0 else F.expr(shown(p)) for i, p in enumerate(pieces)]
    return F.concat(*cols)


WDH = {"width": "w", "depth": "d", "height": "h"}
WDHL = {**WDH, "length": "l"}
ROUND = {"diameter": "o", "height": "h"}

# code: [(text for even part keys, what it says), (text for odd part keys, what it says)]
FORMS = {
    "generic": [('{wf}"W x {df}"D x {hf}"H', WDH), ("Dia: {of} x Weight: {wt} kg", {"diameter": "o", "weight": "wt"})],
    "DSH": [('Large - {w}" W x {d}" D (37" Ext.) x {h}" H', WDH), ('{o}-99" Diameter x {h}" H\nSeat Height: {sh}', {**ROUND, "seat_height": "sh"})],
    "WA": [('OVERALL: {w}"W {d}"D {h}"H | SEAT HEIGHT: {sh}" | {wt} lbs', {**WDH, "seat_height": "sh", "weight": "wt"}), ("Rectangular: depth {df}in width {wf}in height {hf}in Oval: width 99in", WDH)],
    "SB": [('Overall: {w}" W x {d}" D x {h}" H | Seat Height: {sh}", Arm Height: {ah}"', {**WDH, "seat_height": "sh", "arm_height": "ah"}), ('{lf}" x {wf}" x {hf}"<br>Weight: {wt} lbs', {"length": "l", "width": "w", "height": "h", "weight": "wt"})],
    "HEN": [('{w}" W x {h}" H x {d}" D', WDH), ('{o}" dia x {h}"', ROUND)],
    "INT": [('{hf}"H x {wf}"W x {df}"D; SD {sd}"; SH {sh}"; AH {ah}"', {**WDH, "seat_depth": "sd", "seat_height": "sh", "arm_height": "ah"}), ('{of}" DIA; Weight: {wt} lbs', {"diameter": "o", "weight": "wt"})],
    "COL": [('WIDTH: {w}" | HEIGHT: {h}" | DEPTH: {d}" | WEIGHT: {wt} LBS', {**WDH, "weight": "wt"}), ('Diameter: {o}"\nHeight: {h}"\nLength: {l}"', {**ROUND, "length": "l"})],
    "LIA": [("{w} x {d} x {h} inch", WDH), ("Diam. {o}x{h} inch", ROUND)],
    "REJ": [("Width: {wf}\nDepth: {df}\nHeight: {hf}\nWeight: {wt} lbs", {**WDH, "weight": "wt"}), ("Fixture Width: {wf}\nProjection: {df}\nDiameter: {of}\nSeat Height: {sh}", {"width": "w", "depth": "d", "diameter": "o", "height": "sh", "seat_height": "sh"})],
    "PB": [('{w}"w x {d}"d x {h}"h; seat height {sh}"; weight {wt} lbs', {**WDH, "seat_height": "sh", "weight": "wt"}), ('{h}” oah x {o}”dia. fixture', ROUND)],
    "AF": [("Total Width: {w} | Total Height: {h} | Depth: {d} | Projection: 99", WDH), ('{o}" Dia | {l}" L | Weight: {wt} | Center to Center: 12', {"diameter": "o", "length": "l", "weight": "wt"})],
    "EI": [("W. {w}″ | D. {d}″ | H. {h}″ | SD. {sd}″ | SH. {sh}″ | SW. {sw}″ | AH. {ah}″", {**WDH, "seat_depth": "sd", "seat_height": "sh", "seat_width": "sw", "arm_height": "ah"}), ("Ø {o}″ | H. {h}″", ROUND)],
    "ZUO": [('{w}" W x {d}" D x {h}" H', WDH), ('{o}" Dia x {h}" H', ROUND)],
    "SU": [('{h}"H x {w}"W x {d}"D', WDH), ("{l} x {w}", {"length": "l", "width": "w"})],
    "CHE": [("H {h} x W {w} x D {d}", WDH), ("{l} x {w}", {"length": "l", "width": "w"})],
    "SS": [('H: {h}" W: {w}" D: {d}"', WDH), ('{w}" x {h}" x {d}"', WDH)],
    "AK": [("Side table {w} x {d} x {h} h in oak", WDH), ("Lamp {o} dia x {h} h", ROUND)],
    "BEN": [('{l}" x {w}" x {h}" H ({sh}" to seat) COM 4 yards', {"length": "l", "width": "w", "height": "h", "seat_height": "sh"}), ('{l}L {w}W {o}DIA {h}H', {"length": "l", "width": "w", "diameter": "o", "height": "h"})],
    "NC": [('{w}"W x {d}"D x {h}"H', WDH), ("{o} DIA x {h}H", ROUND)],
    "TRO": [("%3Cp%3E{w} W x {d} D x {h} H%3C/p%3E%3Cp%3ESeat Height {sh}%3C/p%3E", {**WDH, "seat_height": "sh"}), ("%3Cp%3E{o} Diam x {h} H%3C/p%3E%3Cp%3EArm Height {ah}%3C/p%3E", {**ROUND, "arm_height": "ah"})],
    "JBI": [("{w} W x {d} D x {h} OAH", WDH), ('{o}" Diam. x {h} H', ROUND)],
    "HON": [('{w}"W x {d}"D x {h}"H, weigth', {**WDH}), ("{o} DIA x {h} H x {wt} WEIGTH", {**ROUND, "weight": "wt"})],
    "QUA": [('{w}″ W x {d}″ D x {h}″ H, {wt} lbs', {**WDH, "weight": "wt"}), ('{o}" DIA Standard height: {h}"', ROUND)],
    "MCL": [("W: {w} H: {h} D: {d} Weight: {wt}", {**WDH, "weight": "wt"}), ("{w}W x {h}H", {"width": "w", "height": "h"})],
    "MBL": [('Overall: {w}"W × {d}"D × {h}"H', WDH), ("Width: {w}\nDepth: {d}\nHeight: {h}", WDH)],
    "UM": [("{w} W x {d} D x {h} H", WDH), ("{o} Dia. x {h} H", ROUND)],
    "VH": [("{w}W x {d}D x {h}H", WDH), ("99W | {o} DIA x {h}H x {w}W x {l}L", {**ROUND, "width": "w", "length": "l"})],
    "HOL": [("{w} W x {d} D x {h} H", WDH), ("{o} dia x {h}h {wt} lbs", {**ROUND, "weight": "wt"})],
    "VER": [('{l}″ L x {w}″ W x {h}″ H', {"length": "l", "width": "w", "height": "h"}), ('W {w}" | D {d}" | H {h}" | {wt} lbs', {**WDH, "weight": "wt"})],
    "WAW": [('{w}" W x {d}" D x {h}" H', WDH), ('{o}" DIAM x {h}" HT', ROUND)],
    "ALM": [('{l}” L x {w}” W x {d}” D x {h}” H', WDHL), ('{o}” DIA x {h}” H', ROUND)],
    "CAR": [("Dimensions in Inches: {w}W X {d}D X {h}H", WDH), ("Dimensions in Inches: {o} DIA X {h}H", ROUND)],
    "CHA": [("W {w} D {d} H {h}", WDH), ("h {h} w 99 w {w}", {"height": "h", "width": "w"})],
    "CRL": [("{w}W x {d}D x {h}H", WDH), ("{o} DIA x {h} H x 99 H", ROUND)],
    "CUR": [('{w}" w x {d}" d x {h}" h', WDH), ('{o}" dia. x {h}" h x 99 w', ROUND)],
    "SUN": [("Overall Dimensions: {w} W x {d} D x {h} H\nNet Weight: {wt} lb\nSeat Height: {sh} in", {**WDH, "weight": "wt", "seat_height": "sh"}), ("Gross Weight: 99 lb\nOverall Dimensions: {o} DIA x {h} H\nCarton Weight: {wt} lb", {**ROUND, "weight": "wt"})],
    "JAN": [('W: {w}"\nD: {d}"\nH: {h}"\nSH: {sh}"', {**WDH, "seat_height": "sh"}), ("DIAM: {o}\nHEIGHT: {h}\nWEIGHT: {wt} lbs", {**ROUND, "weight": "wt"})],
    "CEN": [("<p>OVERALL WIDTH: {w}</p><p>DEPTH: {d}</p><p>HEIGHT: {h}</p>", WDH), ("<p>HEIGHT: 99</p><p>OVERALL HEIGHT: {h}</p><p>DIAMETER: {o}</p><p>WEIGHT: {wt}</p>", {**ROUND, "weight": "wt"})],
    "PF": [("L 100 x P 50 cm\nL {l} x P {d} x H {h} inch", {"length": "l", "depth": "d", "height": "h"}), ("Dia. {o} x H {h} inches", ROUND)],
    "TFP": [('L {l}" × W {w}" × H {h}"', {"length": "l", "width": "w", "height": "h"}), ('Dia. {o}" x H {h}"', ROUND)],
    "ST": [("W {w} D {d} H {h} SH {sh} SD {sd}", {**WDH, "seat_height": "sh", "seat_depth": "sd"}), ("Ø {o} H {h}", ROUND)],
    "BRC": [("W: {w} D: {d} H: {h}", WDH), ("W {w} H {h} ARM HEIGHT {ah}", {"width": "w", "height": "h", "arm_height": "ah"})],
    "PAL": [('{wf}" W x {df}" D x {hf}" H', WDH), ('{of}" Dia x {hf}" H', ROUND)],
    "REM": [('Backplate: 5\nOverall: {h}" h x {w}" w x {d}" d', WDH), ('Overall: {h}" h x {o}" diameter\nDepth: {d}', {**ROUND, "depth": "d"})],
    "PAH": [("Width: {wf}″\nHeight: {hf}″", {"width": "w", "height": "h"}), ("Diameter: {of}″ Dia.\nDepth: {df}″", {"diameter": "o", "depth": "d"})],
    "ROW": [('Weight (lb): 9\nDimension (IN): W{w} D{d} H{h}"', WDH), ("Dimensions (in) DIA {o} x H {h}", ROUND)],
    "HIC": [("W {w} x D {d} x H {h}", WDH), ("W {w} x D {d}, {h} high", WDH)],
    "EIcm": [("W={w};D={d};H={h}", None), ("{w} x {d} x {h} cm", None)],
    "BD": [("Overall | W: {w} | D: {d} | H: {h}\nSeat | W: {sw} | D: {sd} | H: {sh}\nArm | H: {ah}", {**WDH, "seat_width": "sw", "seat_depth": "sd", "seat_height": "sh", "arm_height": "ah"}), ("Overall | D: {d} | H: {h} | D: {o}\nArm | W: {aw}", {"depth": "d", "height": "h", "diameter": "o", "arm_width": "aw"})],
    "DWR": [('Overall Width (in): {w}"\nOverall Depth (in): {d}"\nSeat Height (with: cushion): {sh}"', {"width": "w", "depth": "d", "seat_height": "sh"}), ("Diameter: {of}\nHeight: {hf}\nWeight: {wt} lb\nWeight Capacity: 300", {**ROUND, "weight": "wt"})],
    "GB": [('Width: {w}", 99"\nDepth: {d} in\nHeight: {h}"', WDH), ("Diameter: {o}\nWeight: {wt} lbs", {"diameter": "o", "weight": "wt"})],
    "SUT": [("Width: {w} in / 99 cm | Depth: {d} in | Height: {h} in", WDH), ("Diameter: {o}/12 | Seat Height: {sh}in", {"diameter": "o", "seat_height": "sh"})],
    "SBV": [("W: {w} | D: {d} | H: {h} | WEIGHT: {wt}", {**WDH, "weight": "wt"}), ("DIA: {o} | H: {h}", ROUND)],
    "ART": [("Weight: {wt} lbs Width: {w} in Depth: {d} in", {"weight": "wt", "width": "w", "depth": "d"}), ("Diameter: {o} Length - {l} Width: {w}", {"diameter": "o", "length": "l", "width": "w"})],
    "CRLT": [("OUTSIDE: {w}W x {d}D x {h}H\nSEAT: {sh} in\nARM: {ah} in", {**WDH, "seat_height": "sh", "arm_height": "ah"}), ("OUTSIDE DIM: {o} DIA x {h} H\nWEIGHT: {wt} lbs", {**ROUND, "weight": "wt"})],
    "PHC": [('{w} x {d} x {h}"h (12 x 12 packed)', WDH), ("{w}x{d}x{h}", WDH)],
}

NUMERIC = [f for f in FIELDS if f != "shade"]


def oracle(forms) -> str:
    cols = ["p_partkey"]
    for f in NUMERIC:
        sides = []
        for _, says in forms:
            if says is None:
                sides.append(f"round_even({value(f[0])} / 2.54, 2)" if f in ("width", "depth", "height") else "null")
            else:
                sides.append(value(says[f]) if f in says else "null")
        cols.append(f"cast(case when p_partkey % 2 = 0 then {sides[0]} else {sides[1]} end as double) as {f}")
    return f"select {', '.join(cols)} from part"


def spec_texts(parts, code: str):
    even, odd = (text_column(t) for t, _ in FORMS[code])
    return parts.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, even).otherwise(odd).alias("spec"))


def measured(df, code: str):
    return numeric_fields(extract_dimensions(df, "spec", code), NUMERIC)


def numeric_fields(df, fields, keys=("p_partkey",), dims: str = "dims"):
    """The fields as doubles; one function over an array instead of one per field."""
    raw = F.array(*[F.translate(F.col(f"{dims}.{f}"), '"', "") for f in fields])
    staged = df.select(*keys, F.transform(raw, fraction_value).alias("v"))
    return staged.select(*[c for c in staged.columns if c != "v"], *[F.get("v", F.lit(i)).alias(f) for i, f in enumerate(fields)])


def _register(code: str) -> None:
    @query(f"dims_{code.lower()}", oracle(FORMS[code]))
    def run(spark, sf):
        parts = texts(spark, sf, "part").select("p_partkey", "p_size")
        return measured(spec_texts(parts, code), code)


for _code in PACKS:
    _register(_code)


# --- all grammars in one table ----------------------------------------------

#: Pairs of part keys take turns through the grammars, an unknown one and none.
PLACE, CODES = "cast(floor(p_partkey / 2) as int) % 58", [*PACKS, "?", None]
#: What two grammars are given beyond their fields, and how they keep it.
LEFT_OVER = {
    "BD": ("\nCanopy | W: {aw} | H: 5\nCord | {wt}\nSeat | Q: 9\nOverall | Q: 3", f"concat('Canopy H=5;Canopy W=', {shown('aw')}, ';Cord=', {shown('wt')})"),
    "DWR": ("\nCord Length (max): {wt} in\nBulb: none\nWeight Capacity: {sh}", f"concat('Bulb=none;Cord Length=', {shown('wt')}, ';Weight Capacity=', {shown('sh')})"),
}


def routed_sql() -> str:
    each = []
    for i, code in enumerate(CODES):
        here = f"{PLACE} = {i}"
        if code in FORMS:
            kept = LEFT_OVER[code][1].replace("as string", "as varchar") if code in LEFT_OVER else "null"
            # A seat line stands in every other text of the first grammar, so the second one there is not read.
            kept = f"case when p_partkey % 2 = 0 then {kept} else concat({kept}, ';Seat Q=9') end" if code == "BD" else kept
            each.append(f"select p.*, '{code}' as pack, cast(k.extras as varchar) as extras from ({oracle(FORMS[code])} where {here}) p join (select p_partkey as k, {kept} as extras from part) k on k = p_partkey")
        else:
            nothing = ", ".join(f"cast(null as double) as {f}" for f in NUMERIC)
            each.append(f"select p_partkey, {nothing}, {'null' if code is None else repr(code)} as pack, null as extras from part where {here}")
    return " union all ".join(each)


@query("dims_all_grammars", routed_sql())
def _(spark, sf):
    from ..spec.router import route_grammars

    parts = texts(spark, sf, "part").select("p_partkey", "p_size", F.expr(PLACE).alias("place"))
    spec, code = F.lit("W: 3"), F.lit(None).cast("string")
    for i, c in enumerate(CODES):
        if c is not None:
            code = F.when(F.col("place") == i, c).otherwise(code)
        if c in FORMS:
            even, odd = (text_column(t + LEFT_OVER.get(c, ("",))[0]) for t, _ in FORMS[c])
            spec = F.when(F.col("place") == i, F.when(F.col("p_partkey") % 2 == 0, even).otherwise(odd)).otherwise(spec)
    read = route_grammars(parts.select("p_partkey", code.alias("pack"), spec.alias("spec")), "spec", "pack")
    left = F.array_join(F.array_sort(F.transform(F.map_entries("extras"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return numeric_fields(read.withColumn("left", left), NUMERIC, ["p_partkey", "pack", F.col("left").alias("extras")])
