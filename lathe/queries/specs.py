"""Spec text: line tables, sections, pipe lists, attributes, rule tables."""

from pyspark.sql import functions as F

from ..functions.numbers import fraction_value
from ..spec.packs import shade_numbers
from ..spec import attrs as A
from ..spec import lines as L
from .measures import shown, value
from .registry import query, texts


def S(c):
    return F.col(c).cast("string")


def parts(spark, sf):
    return texts(spark, sf, "part")


def text(template: str):
    """Template over part columns: {size}, {key}, {name}, {type}, {brand}, {next}."""
    import re

    named = {"size": S("p_size"), "next": (F.col("p_size") + 1).cast("string"), "key": S("p_partkey"), "name": F.col("p_name"), "type": F.col("p_type"), "brand": F.col("p_brand")}
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else named[p] for i, p in enumerate(pieces)])


def attr_query(name: str, sql_cols: str, cols):
    @query(name, f"select p_partkey, {sql_cols} from part")
    def run(spark, sf):
        return parts(spark, sf).select("p_partkey", *[c.alias(n) for n, c in cols().items()])

    return run


BLOB = 'Height: {size}"\nHeight: 30 cm\nWidth: {size} cm\nChain Length: 6 feet\nFinish: {name}\nFinish: {type}\nNotes:\nCare: care\nno label'


@query(
    "spec_multimap",
    """select p_partkey, i as pos, case i when 0 then 'Height' when 1 then 'Height' when 2 then 'Width' when 3 then 'Chain Length' else 'Finish' end as label,
    case i when 0 then concat(p_size, '"') when 1 then '30 cm' when 2 then concat(p_size, ' cm') when 3 then '6 feet' when 4 then p_name else p_type end as value from part, (select unnest([0,1,2,3,4,5]) i) t""",
)
def _(spark, sf):
    return L.label_table(parts(spark, sf).withColumn("spec", text(BLOB)), "p_partkey", "spec")


@query(
    "spec_final_values",
    """select p_partkey, label, case label when 'Height' then concat(p_size, '"') when 'Chain Length' then '6 feet' else p_name end as value from part, (select unnest(['Height', 'Chain Length', 'Finish']) label) t""",
)
def _(spark, sf):
    return L.final_values(L.label_table(parts(spark, sf).withColumn("spec", text(BLOB)), "p_partkey", "spec"), "p_partkey")


@query("spec_standard_attributes", """select p_partkey, p_size::varchar as width, concat(p_size + 1, ' in') as seat_height, null::varchar as depth, p_type as weight from part""")
def _(spark, sf):
    long = L.label_table(parts(spark, sf).withColumn("spec", text("W: 99\nwidth: {size}\nSH: {next} in\nWT: {type}\nOther: x")), "p_partkey", "spec")
    wide = L.standard_attributes(long, "p_partkey")
    return wide.select("p_partkey", F.col("Width").alias("width"), F.col("`Seat Height`").alias("seat_height"), F.col("Depth").alias("depth"), F.col("Weight").alias("weight"))


@query("table_standard_attributes", """select p_partkey, p_size::varchar as width, concat(p_size + 1, ' in') as seat_height, null::varchar as depth, p_type as weight, '' as height from part""")
def _(spark, sf):
    html = text(
        "<table><tr><th>W</th><td>99</td></tr><tr><td> Width </td><td><b>{size}</b></td><td>{key}</td></tr>"
        "<tr><td>SH</td><td>{next}&nbsp;in</td></tr><tr><td>Depth</td></tr><tr><td>WT</td><td>{type}</td></tr><tr><td>H</td><td></td></tr><tr><td>Other</td><td>x</td></tr></table>"
    )
    wide = L.table_attributes(parts(spark, sf).withColumn("html", html), "p_partkey", "html")
    return wide.select("p_partkey", F.col("Width").alias("width"), F.col("`Seat Height`").alias("seat_height"), F.col("Depth").alias("depth"), F.col("Weight").alias("weight"), F.col("Height").alias("height"))


@query("section_split", "select p_partkey, concat(p_name, chr(10), p_type) as finish, p_size::varchar as lamping, null::varchar as notes, concat('late ', p_brand) as mounting from part")
def _(spark, sf):
    s = L.sections(text("intro\nFinish: {name}\n{type}\nLamping\n{size}\nMounting: first\nMOUNTING\nlate {brand}\n"), ["Finish", "Lamping", "Notes", "Mounting"])
    return parts(spark, sf).select("p_partkey", *[c.alias(n.lower()) for n, c in s.items()])


@query("caps_header_sections", "select p_partkey, concat(p_size, ' lbs') as weight, concat(p_name, chr(10), p_brand) as material, p_brand as socket from part")
def _(spark, sf):
    s = L.caps_sections(text("WEIGHT{size} lbs\nMATERIAL\n{name}\n{brand}\nSOCKET TYPE\n{brand}"))
    pick = {"weight": ("WEIGHT",), "material": ("MATERIAL", "MATERIALS"), "socket": ("SOCKET", "SOCKET TYPE")}
    return parts(spark, sf).select("p_partkey", *[F.coalesce(*[F.try_element_at(s, F.lit(k)) for k in ks]).alias(n) for n, ks in pick.items()])


@query(
    "pipe_alias_spec",
    "select p_partkey, concat(p_name, ' | ', p_type) as finish, p_size::varchar as weight, concat(p_size, ' Watt') as wattage, 'E27' as socket, null::varchar as fabric from part",
)
def _(spark, sf):
    a = L.pipe_attributes(text("General info: {name} | {type} | Lamp holder qty: 1 | Lamp holder: E27 | Voltage: 110 | Max wattage load: no | Wattage: max {size}W | Max weight load: {size} lbs"))
    return parts(spark, sf).select("p_partkey", *[a[k].alias(k.lower()) for k in ("Finish", "Weight", "Wattage", "Socket", "Fabric")])


@query("block_after_label", "select p_partkey, p_name as inline, concat(p_type, ' ', p_size) as below, null::varchar as absent, concat(p_name, chr(10), p_type) as multi from part")
def _(spark, sf):
    known = ["Overall", "Shade", "Canopy", "Cord"]
    t = text("Overall: {name}\nShade\n{type}\n{size}\nCanopy:\n5")
    m = text("Seat: x\nDimensions : {name}\n{type}\nConstruction: y")
    return parts(spark, sf).select("p_partkey", L.block_after(t, "Overall", known).alias("inline"), L.block_after(t, "Shade", known).alias("below"), L.block_after(t, "Cord", known).alias("absent"), L.block_lines(m, "Dimensions", ["Seat", "Construction"]).alias("multi"))


attr_query("line_after_label", "p_name as finish, concat(p_size, ' K') as color_temperature, p_type as socket_type, concat(p_size, 'W') as wattage", lambda: A.lighting_lines(text("Finish\n{name}\nColor Temperature\nwarm\n{size} K\nSocket Type\n{type}\nWattage\n{size}W")))

attr_query(
    "spec_sheet_keys",
    "p_name as material, p_type as finish, null::varchar as shade, concat('LED ', p_size) as bulb_type, 'Italy' as country",
    lambda: {k: v for k, v in L.sheet_attributes(text("Body Material: {name}\nColor: red\nPowder Coat: {type}\nColor: {type}\nLamp Type: LED {size}\nMade in: Italy\nempty:")).items() if k in ("material", "finish", "shade", "bulb_type", "country")},
)

attr_query(
    "ordered_line_rules",
    "p_size::varchar as weight, concat('W', p_size, ' D', p_size + 1) as dimension, 'solid' as construction, p_type as content, p_name as color, (p_size + 1)::varchar as seat_height, null::varchar as seat_depth, p_size::varchar as arm_height, concat(p_size, ', down') as cushion",
    lambda: L.ordered_line_rules(text('Weight (lb): {size}\nDimension (IN): W{size} D{next}"\nSeat Height (IN) {next}\nArm Height (IN): {size}\nNumber of Cushions: {size}\nStandard Cushion: down\nKD Construction: solid\nContent: {type}\nColor: {name}\nColor: other')),
)

attr_query(
    "seat_arm_abbreviations",
    "p_size::varchar as seat_width, (p_size + 1)::varchar as seat_depth, '17.5' as seat_height, p_size::varchar as arm_height",
    lambda: {f: A.seat_by_abbreviation(text('{size}" SW x {next}" SD x 17.5" SH, AH: {size}'), f) for f in ("seat_width", "seat_depth", "seat_height", "arm_height")},
)
attr_query("seat_by_letters", "p_size::varchar as seat_height, (p_size + 1)::varchar as seat_depth, null::varchar as seat_width", lambda: A.seat_by_letters(text("h 1 H {size} d {next}")))
attr_query(
    "measure_map",
    "p_size::varchar as seat_height, (p_size + 1)::varchar as between_arms, (p_size)::varchar as labelled, p_size::varchar as size_w, (p_size + 1)::varchar as size_d",
    lambda: {
        "seat_height": F.try_element_at(A.measure_map(text('seat  height: {size}.0" Seat Height 99 Width Between Arms {next}')), F.lit("Seat Height")),
        "between_arms": F.try_element_at(A.measure_map(text('seat  height: {size}" Width Between Arms {next}')), F.lit("Width Between Arms")),
        "labelled": A.labelled_measure(text("Arm Height: {size} in"), "Arm Height"),
        "size_w": A.seat_size(text("Seat Size: {size} x {next}"))["seat_width"],
        "size_d": A.seat_size(text("Seat Size: {size} x {next}"))["seat_depth"],
    },
)

attr_query(
    "weight_rules",
    """case when p_size % 2 = 0 then p_size::varchar end as lb_only, p_size::varchar as lb_or_number, p_size::varchar as lb_strict, p_size::varchar as product, concat(p_size, ' lb') as with_unit, concat(p_size, ' kg') as any_unit, p_size::varchar as piped, p_size::varchar as no_unit,
    p_size::varchar as item, p_size::varchar as by_kind, p_size % 2 = 0 as mentions""",
    lambda: {
        "lb_only": A.weight_lb_only(F.when(F.col("p_size") % 2 == 0, text("9 kg / LBS: {size}")).otherwise(text("{size} KG"))),
        "lb_or_number": A.weight_lb_or_number(text("9 kg, {size} pounds")),
        "lb_strict": A.weight_lb_strict(text("{size} lbs (390 lbs packed)")),
        "product": A.weight_of_product(text("Shade weight: 3 lbs\nTotal Product Weight*: {size} lbs")),
        "with_unit": A.weight_with_unit(text("box 99 lb Weight: {size} ib")),
        "any_unit": A.weight_any_unit(text("net {size} KG")),
        "piped": A.weight_in_pipe_part(text("a 9 | Weight: {size} Lbs | 8")),
        "no_unit": A.weight_without_unit(text("{size} lbs")),
        "item": A.weight_item_or_fixture(text("Fixture Weight: {size}")),
        "by_kind": A.weight_by_kind(text("Gross Weight: 99 lb\nNet Weight: {size} lb")),
        "mentions": A.mentions_weight(F.when(F.col("p_size") % 2 == 0, text("{size} lbs")).otherwise(text("{size} long"))),
    },
)

attr_query(
    "com_col_cot",
    """concat(p_size, '.5') as com, (p_size + 1)::varchar as col, '2,3' as cushion, p_size::varchar as com2, (p_size + 1)::varchar as col2, p_size::varchar as note_com, '8.5' as note_cot, p_size::varchar as up_com, 'two loose' as up_cushion, p_size::varchar as html_com, (p_size + 1)::varchar as html_col, concat(p_size, ' yards') as line_com, p_size::varchar as near_com, p_size::varchar as req_com""",
    lambda: {
        "com": A.com_col(text("COM/COL: {size}.5 yds / {next} Sq Ft, 2 Seat Cushions 3 Back Cushions"))["com"],
        "col": A.com_col(text("COM/COL: {size}.5 yds / {next} Sq Ft"))["col"],
        "cushion": A.com_col(text("COM/COL: {size} yds / 9, 2 Seat Cushions 3 Back Cushions"))["cushion"],
        "com2": A.com_col(text("COM:Headboard {size} yds COL:Headboard {next} sq ft"))["com"],
        "col2": A.com_col(text("COM:Headboard {size} yds COL:Headboard {next} sq ft"))["col"],
        "note_com": A.com_col_cot(text("COM {size} Yds COL 72 Sq Ft COT 8.5 Yds"))["com"],
        "note_cot": A.com_col_cot(text("COM {size} Yds COL 72 Sq Ft COT 8.5 Yds"))["cot"],
        "up_com": A.upholstery(text("COL: 9 CUSHION: two  loose COM: {size} yds"))["com"],
        "up_cushion": A.upholstery(text("COL: 9 CUSHION: two  loose COM: {size} yds"))["cushion"],
        "html_com": A.com_lines(text("<b>{size} yards</b><br>{next} sqft"))["com"],
        "html_col": A.com_lines(text("<b>{size} yards</b><br>{next} sqft"))["col"],
        "line_com": A.com_line_text(text("x COM 9\nCOM: {size} yards")),
        "near_com": A.com_near_yards(text("needs COM fabric {size} yds")),
        "req_com": A.com_or_requirement(text("Upholstery Requirements: {size} yards"))["com"],
    },
)

attr_query(
    "socket_wattage",
    """'E26' as e_socket, concat(p_size, 'W - 75W Max') as e_watt, 'E26 Socket' as d_socket, concat(p_size, ' Max Wattage') as d_watt, 'E12, G9 Bulb' as p_socket, concat('2 X ', p_size, 'W') as p_watt, 'GU10' as code, concat('E26, ', p_size) as typed, concat(p_size, 'W, 90 CFM/Watt') as energy,
    concat(p_size, ' Watt') as cleaned, 'E27' as holder, p_size::varchar as most, concat(p_size, 'W') as labelled, 'LED, MR16' as base, '2700' as kelvin""",
    lambda: {
        "e_socket": A.electrical(text("1 x E26 {size}W - 75W Max - LED bulb"))["socket"],
        "e_watt": A.electrical(text("1 x E26 {size}W - 75W Max - LED bulb"))["wattage"],
        "d_socket": A.semicolon_details(text("E26 Socket; {size} Watts"))["socket"],
        "d_watt": A.semicolon_details(text("E26 Socket; {size} Watts"))["wattage"],
        "p_socket": A.pipe_socket_wattage(text("E12 SOCKET | G9 Bulb | 2 X {size}W"))["socket"],
        "p_watt": A.pipe_socket_wattage(text("E12 SOCKET | G9 Bulb | 2 X {size}W"))["wattage"],
        "code": A.socket_code(text("Lamping: {size} x GU10 lamps")),
        "typed": A.socket_type_count(text("Socket Type: E26\nNumber of Sockets: {size}")),
        "energy": A.max_wattage_line(text("Max. Wattage per Socket: {size} W\nEnergy Efficiency: 90 CFM / Watt")),
        "cleaned": A.clean_wattage(text("Max wattage: {size}W LED")),
        "holder": A.clean_socket(F.lit("Lamp holder: E27")),
        "most": A.watts_max(text("bulb {size} W max")),
        "labelled": A.max_wattage_label(text("Max Wattage: {size}W")),
        "base": A.illumination(text("{size} w LED MR16, 2700 K"))["base"],
        "kelvin": A.illumination(text("{size} w LED MR16, 2700 K"))["color_temperature"],
    },
)

attr_query(
    "shade_details",
    """concat(p_size, ', 9.84, 11.81') as inch_list, concat(p_size, ' x 12') as phrase, concat('9, ', p_size, ', 7') as three, concat(p_size, ', 8.5') as measures, concat('Dia. ', p_size, '" x H 5') as piped, concat('SH', p_size) as line, p_name as semi, p_type as semi_finish""",
    lambda: {
        "inch_list": F.replace(shade_numbers(text("Shade: Bottom Ø {size}″ | Top Ø 9.84″ | H. 11.81″")), F.lit(","), F.lit(", ")),
        "phrase": A.shade_phrase(text("Lamp with silk shade, {size} x 12, white")),
        "three": A.shade_three_part(text('Shade Top\n9"\nShade Bottom\n{size}"\nShade Height\n7"')),
        "measures": A.shade_measures(text('Fixture Width with Shade: {size}"\nProjection with Shade: 8.5"')),
        "piped": A.shade_pipe(text('H 9 | Shade: Dia. {size}" x H 5'), F.lit("x")),
        "line": A.shade_line(text("Shade: SH{size} Linen with trim\nmore")),
        "semi": A.semicolon_parts(text("Shade: {name}; Finish: {type}"))["shade"],
        "semi_finish": A.semicolon_parts(text("Shade: {name}; Finish: {type}"))["finish"],
    },
)

attr_query(
    "canopy_base_height",
    """p_size::varchar as canopy, (p_size + 1)::varchar as backplate, p_size::varchar as marked, concat('5/8", ', p_size, '" Ø') as parts, p_size::varchar as plate, p_size::varchar as height_now, (p_size + 1)::varchar as height_min, '99' as height_overall, p_size::varchar as oah, concat('Base: ', p_size, '"') as base, concat_ws(', ', p_size, p_size + 1) as dia_height, (p_size + 1)::varchar as dia_only""",
    lambda: {
        "canopy": A.line_number(text("x\nCanopy: {size} in"), "canopy"),
        "backplate": A.line_number(text("Backplate: {next} in"), "backplate"),
        "marked": A.canopy_marked(text('a | Canopy {size}" Square | b')),
        "parts": A.canopy_parts(text('5/8" stem\nCANOPY\n{size}" Ø\nplain words\nNEXT PART\n9" x')),
        "plate": A.canopy_diameter(text('Canopy Diameter: {size}"\nx')),
        "height_now": A.height_precedence(text("min height: 9\nCurrent Height: {size}"), F.lit("99")),
        "height_min": A.height_precedence(text("Minimum Height: {next}"), F.lit("99")),
        "height_overall": A.height_precedence(text("Height: {next}"), F.lit("99")),
        "oah": A.overall_height(text("lamp {size} oah")),
        "dia_height": A.canopy_dia_height(text("DIA: 9 | CANOPY DIA: {size} | Canopy H: {next} | H: 3")),
        "dia_only": A.canopy_dia_height(text("H: 3 | CANOPY  DIA: {next} | W: 8")),
        "base": A.base_block(text('H 9 | Base: {size}"'), F.lit("")),
    },
)

attr_query(
    "finish_materials",
    """concat(p_name, ', ', p_brand, ', brushed') as options, p_name as general, p_type as fabric, concat(p_name, ', ', p_type) as bullets, p_name as para, p_type as breaks, p_name as materials, concat(p_name, ', ', p_type) as seat, p_brand as cushion, concat('Socket ', p_name) as pipe_socket""",
    lambda: {
        "options": A.finish_options(text("METAL FINISH\n{brand}\nGLASS FINISHES\n{name}\nWhen ordering, say so\nlost\nFINISH\nbrushed\nCANOPY\nx")),
        "general": A.clean_finish(text("General info: {name}")),
        "fabric": A.clean_fabric(text("Fabric composition: {type}")),
        "bullets": A.bulleted_finishes(text("<p>Finishes:<br>• {name} (std)<br>• {type}</p><p>Sizes</p>")),
        "para": A.paragraph_field(text("<p>Seat: oak</p><p>Finish: {name}</p>"), "Finish"),
        "breaks": A.finish_after_break(text("x<br>Finish: {type}<br>y")),
        "materials": A.materials_block(text("Weight | Materials: {name} | y")),
        "seat": A.construction_table(text("Seat Construction: {name}\nCover Fabric: {type}\nBack Cushion: {brand}"))["seat"],
        "cushion": A.construction_table(text("Seat Construction: {name}\nBack Cushion: {brand}"))["cushion"],
        "pipe_socket": A.pipe_lines(text("12W | Socket {name} | 9 Watt"))["socket"],
    },
)

attr_query(
    "pipe_label_fields",
    """p_size::varchar as weight, (p_size + 1)::varchar as seat_depth, p_size::varchar as arm_width, p_size::varchar as com, p_name as shade, p_type as extra, p_brand as single""",
    lambda: {
        **{k: A.pipe_fields(text("Item Weight: {size} lb | Seat Depth (in): {next} | Arm Width: 99 | Seat Arm Width: {size} | COM: 1 | Number of Yards to Recover: {size} | Shade Included?: {name}"))[k] for k in ("weight", "seat_depth", "arm_width", "com", "shade")},
        "extra": F.try_element_at(A.pipe_map(text("Wood: x | Wood: {type}")), F.lit("Wood")),
        "single": A.pipe_value(text("Maker: {brand} | Other: z"), "Maker"),
    },
)

attr_query(
    "rug_attributes",
    "p_type as construction, p_name as material, concat('0.', p_size) as pile_height, null::varchar as backing, 'India' as country_of_origin",
    lambda: A.rug_fields(text('Construction: {type}\nMaterial: {name}\nPile Height: 0.{size}"\nCountry of Origin: India')),
)


# --- rule table: user-supplied grammar ------------------------------------

RULES = [
    ("width", 1, r"([\d.]+)\s*\"\s*W\b", 1),
    ("width", 2, r"\bW:?\s*([\d.]+)", 1),
    ("depth", 1, r"([\d.]+)\s*\"\s*D\b", 1),
    ("height", 1, r"([\d.]+)\s*\"\s*H\b", 1),
    ("height", 2, r"\bH:?\s*([\d.]+)", 1),
]


@query("rule_table_extraction", f"select p_partkey, {value('w')} as width, case when p_partkey % 2 = 0 then {value('d')} end as depth, {value('h')} as height from part")
def _(spark, sf):
    from ..spec.rules import extract_with_rules

    even = F.concat(F.expr(shown("w")), F.lit('" W x '), F.expr(shown("d")), F.lit('" D x '), F.expr(shown("h")), F.lit('" H'))
    odd = F.concat(F.lit("W: "), F.expr(shown("w")), F.lit(" H: "), F.expr(shown("h")))
    df = parts(spark, sf).select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, even).otherwise(odd).alias("spec"))
    wide = extract_with_rules(df, "p_partkey", "spec", spark.createDataFrame(RULES, "field string, prio int, pattern string, grp int"), ["width", "depth", "height"])
    return wide.select("p_partkey", *[fraction_value(c).alias(c) for c in ("width", "depth", "height")])


