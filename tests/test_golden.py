"""Stated input/output pairs of the scalar functions and grammars."""

import pytest
from pyspark.sql import functions as F

from lathe.functions import address as A
from lathe.functions import family as FM
from lathe.functions import numbers as N
from lathe.functions import sku as K
from lathe.functions import text as T
from lathe.functions import urls as U
from lathe.operators import audit, filters
from lathe.operators.joins import resolve_list_literal
from lathe.operators.projection import free_name
from lathe.sinks.tables import sheet_name
from lathe.sources import pages as P
from lathe.spec import attrs, lines, packs

SCALARS = [
    (N.fraction_text, "26 3/4 inches", "26.75"),
    (N.fraction_text, "34-1/4", "34.25"),
    (N.fraction_text, "17-3/4", "17.75"),
    (N.fraction_text, "59 1/4", "59.25"),
    (N.fraction_text, "1/4", "0.25"),
    (N.fraction_text, "5.25", "5.25"),
    (N.fraction_text, "12", "12"),
    (N.fraction_text, '21-3/4"', "21.75"),
    (N.fraction_text, "13/16", "0.8125"),
    (N.fraction_text, "–", None),
    (lambda c: N.fraction_text(c, 2, "raw", keep_range=True), "23-25", "23-25"),
    (lambda c: N.fraction_text(c, 4, "raw"), "n/a", "n/a"),
    (N.fraction_text, "22¾", "22.75"),
    (N.inline_vulgar, '13 ⅜"', '13.375"'),
    (N.inline_vulgar, '55 ⅛"', '55.125"'),
    (N.inline_vulgar, '⅞"', '0.875"'),
    (N.spell_super_sub, "13⁹⁄₁₆", "13 9/16"),
    (lambda c: N.number_text(N.kg_to_lb(c), 0), "15", "33"),
    (N.cm_text_to_inch, "31,5 x 40 cm", "12.4 x 15.75 inch"),
    (N.cm_text_to_inch, "Diam. 150x36 cm", "Diam. 59.06 x 14.17 inch"),
    (N.cm_text_to_inch, "Structure - Diam. 29 x 146,5 cm?Base - Diam. 55/50 x 60 cm", "Diam. 11.42 x 57.68 inch"),
    (N.cm_text_to_inch, "LxPxHt 10 x n.a. cm", None),
    (N.prefer_inch, "134 cm / 52,75 inch", "52,75"),
    (N.prefer_inch, "33,08 Lbs", "33,08"),
    (N.price_text, "$1,234.00", "1234.00"),
    (N.price_whole, "1549.00", "1549"),
    (N.price_whole, "$1,549", "1549"),
    (N.price_whole, "call", "call"),
    (N.price_with_symbol, "<span>$</span>7,000", "<span>$</span>7,000"),
    (N.price_with_symbol, "$7,000", "$7,000"),
    (N.price_first_dollar, "Tier 1 – $16,650", "16650"),
    (lambda c: N.number_text(N.cents_heuristic(c), 2), "7495", "74.95"),
    (N.whole_number_text, '5.0"', "5"),
    (T.ascii_digits, "০১২", "012"),
    (T.cut_at_boundary, "Antique brass | alabaster | Extra info: blah", "Antique brass | alabaster"),
    (T.cut_at_boundary, "E27 | Lamp holder qty: 1 | Light bulbs...", "E27"),
    (T.polyester_share, "100% Polyester shell", "100% Polyester"),
    (T.squeeze, " a  b\n", "a b"),
    (T.squeeze_keep_lines, "a  b \n\n c", "a b\nc"),
    (T.html_to_text, "<p>a<br>b &amp; c</p><ul><li>x</li></ul>", "a\nb & c\n- x"),
    (T.unwrap_quoted, '"a ""b"" c"', 'a "b" c'),
    (T.zero_to_null, "0.0", None),
    (T.clean_label, " Pile  Height: ", "pile height"),
    (U.domain, "https://www.Ab.com:80/x", "ab.com:80"),
    (U.with_scheme, "a.com", "http://a.com"),
    (U.base_only, "https://a.com/x/?b#c", "https://a.com/x"),
    (U.last_segment, "http://a/b/c/", "c"),
    (U.segment_after, "http://a/collections/rugs/x", "rugs"),
    (U.segment_after, "http://a/b", "unknown"),
    (U.widest_srcset, "a.jpg 100w, b.jpg 300w, c.jpg 300w", "b.jpg"),
    (U.drop_params, "https://x.com/in/a/?trk=1&z=2#f", "https://x.com/in/a/?z=2"),
    (lambda c: U.set_param(c, "pg", 3), "http://a.com/?a=1&pg=2#f", "http://a.com/?a=1&pg=3#f"),
    (K.sku_token, "BLND-001-P", "BLND-001"),
    (K.sku_capitalised, "ABi-01", "Abi-01"),
    (K.sku_capitalised, "LAYLA-03", "Layla-03"),
    (K.sku_from_item_line, "Item no. VK 120 A", "VK 120 A"),
    (lambda c: K.generated_sku(c, F.lit("Mirrors"), F.lit(1)), "Honest", "HONMI001"),
    (lambda c: K.generated_sku(c, F.lit("O"), F.lit(7), K.PLAIN), "Li", "LIXOX7"),
    (lambda c: K.generated_sku(c, F.lit("Rugs"), F.lit(12345)), "Acme", "ACMRU12345"),
    (lambda c: FM.family_id(c, "R1"), "Blair Pull - Williamsburg", "Blair Pull"),
    (FM.family_id, "Ribbon Cocktail Table-Round", "Ribbon Cocktail Table"),
    (FM.family_id, "Aulad_Hossain", "Aulad"),
    (lambda c: FM.family_id(c, "R3"), "A, B, C", "A, B"),
    (lambda c: FM.family_id(c, "R4b"), "Andalusia Round- Dining Table", "Andalusia Round"),
    (lambda c: FM.family_id(c, "R5"), "Cascade Rug (Taupe)", "Cascade Rug"),
    (lambda c: FM.family_id(c, "R5"), 'Shadow 30" Wall Art - Midnight', 'Shadow 30" Wall Art'),
    (lambda c: FM.family_id(c, "R6"), "FORM NO_001", "FORM NO"),
    (lambda c: FM.family_id(c, "R6"), "WR19.26", "WR19"),
    (lambda c: FM.family_id(c, "R6"), "DUNE #8", "DUNE"),
    (lambda c: FM.family_id(c, "R7"), "Chair and Matte Black", "Chair"),
    (lambda c: FM.family_id(c, "R8"), "Abi-01", "Abi"),
    (lambda c: FM.family_id(c, "R12"), "WROUGHT IRON EIGHT-LIGHT CHANDELIER", "WROUGHT IRON"),
    (lambda c: A.address_parts(c)["state"], "7100 TPC Dr, Suite 100, Orlando, Florida 32822, US", "Florida"),
    (lambda c: A.address_parts(c)["city"], "7100 TPC Dr, Suite 100, Orlando, Florida 32822, US", "Orlando"),
    (attrs.weight_lb_strict, "312 lbs (390 lbs packed)", "312"),
    (attrs.weight_lb_only, "20 KG", None),
    (attrs.pile_height, '0.125"', "0.125"),
    (lambda c: attrs.com_col_cot(c)["cot"], "COM 4 Yds COL 72 Sq Ft COT 8.5 Yds", "8.5"),
    (lambda c: attrs.com_col_cot(c)["col"], "COM 4 Yds COL 72 Sq Ft COT 8.5 Yds", "72"),
    (lambda c: attrs.com_col(c)["com"], "COM/COL: 44.5 yds / 801 Sq Ft", "44.5"),
    (lambda c: attrs.com_col(c)["col"], "COM: 2 yds  COL 54 sq ft", "54"),
    (lambda c: attrs.electrical(c)["socket"], "1 x E26 40W - 75W Max - LED...", "E26"),
    (lambda c: attrs.electrical(c)["wattage"], "1 x E26 40W - 75W Max - LED...", "40W - 75W Max"),
    (lambda c: attrs.electrical(c)["socket"], "1 x 6W LED Only", None),
    (lambda c: attrs.semicolon_details(c)["socket"], "E26 Socket; 60 Watts", "E26 Socket"),
    (lambda c: attrs.semicolon_details(c)["wattage"], "E26 Socket; 60 Watts", "60 Max Wattage"),
    (packs.shade_numbers, "Shade: Bottom Ø 22.83″ | Top Ø 9.84″ | H. 11.81″", "22.83,9.84,11.81"),
    (lambda c: attrs.seat_by_abbreviation(c, "seat_depth"), '19.3" SW x 18.9" SD x 17.5" SH', "18.9"),
    (lambda c: packs.section_field(F.lit("Seat"), c), "h", "Seat Height"),
    (lambda c: packs.section_field(F.lit("Overall"), c), "w", "Width"),
    (lambda c: packs.section_field(F.lit("Drawer"), c), "w", None),
    (lambda c: audit.meta_quality(F.lit("t" * 40), c), "d" * 100, "Good"),
    (lambda c: audit.meta_quality(c, F.lit("")), "", "Poor (missing title & description)"),
    (lambda c: audit.overall_status(c, F.lit("Excellent"), F.lit(25)), "Good", "Excellent"),
    (lambda c: audit.overall_status(c, F.lit("Poor"), F.lit(3)), "Weak", "Poor"),
    (lambda c: resolve_list_literal(c, {"1": "A", "3": "B"}), "3, 9,1", "B | A"),
    (sheet_name, "a/b*c" + "x" * 40, "a b c" + "x" * 26),
    (lambda c: sheet_name(c, ellipsis=True), "y" * 40, "y" * 28 + "..."),
]


@pytest.mark.parametrize("i", range(len(SCALARS)))
def test_scalar(evaluate, i):
    fn, given, expected = SCALARS[i]
    assert evaluate(fn, given) == expected


DIMS = [
    ("EI", "W. 31.5″ | SD. 20", {"width": "31.5", "seat_depth": "20", "depth": None}),
    ("INT", '33"H x 96 1/2"W x 38"D; SD 23-25"; SH 19"; AH 30"', {"height": "33", "width": "96.5", "depth": "38", "seat_depth": "23-25", "seat_height": "19", "arm_height": "30"}),
    ("INT", "MULTIPLE SIZES AVAILABLE", {"height": None, "width": None}),
    ("HEN", '12" dia x 2.9"', {"diameter": "12", "height": "2.9", "width": None}),
    ("HEN", '4" x 13"', {"width": "4", "height": "13"}),
    ("HEN", '5.5" W x 18.5" H x 3.75" D', {"width": "5.5", "height": "18.5", "depth": "3.75"}),
    ("ZUO", '21.3" W x 22.2" D x 35" H', {"width": "21.3", "depth": "22.2", "height": "35"}),
    ("DSH", '16/20/24" H', {"height": "16"}),
    ("DSH", '10-15" DIA', {"diameter": "10"}),
    ("DSH", "32.5 OAH", {"height": "32.5"}),
    ("DSH", '72" W x 20" D (37" Ext.) x 30" H', {"width": "72", "depth": "20", "height": "30"}),
    ("DSH", 'Large - 48" W x 14" H', {"width": "48", "height": "14"}),
    ("DSH", '14 & 16" H', {"height": "14"}),
    ("DSH", '15" Diameter x 23.5" H', {"diameter": "15", "height": "23.5"}),
    ("DSH", '20" W x 30" W x 40" H', {"width": "20", "depth": "30", "height": "40"}),
    ("CAR", "Dimensions in Inches: 46.0W X 12.0D X 72.0H", {"width": "46.0", "depth": "12.0", "height": "72.0"}),
    ("JBI", "10 W x 40 D x 54 OAH", {"width": "10", "depth": "40", "height": "54"}),
    ("JBI", "5\" Diam. x 25 H", {"diameter": "5", "height": "25"}),
    ("CHE", "24 x 36", {"length": "24", "width": "36"}),
    ("CHE", "Dia 20 x H 30", {"diameter": "20", "height": "30", "depth": None}),
    ("PHC", '39x39x15"h', {"width": "39", "depth": "39", "height": "15"}),
    ("WA", 'OVERALL: 29"W 33"D 32"H | SEAT HEIGHT: 18" | SEAT DEPTH: 22.5"', {"width": "29", "depth": "33", "height": "32", "seat_height": "18", "seat_depth": "22.5"}),
    ("WA", "H (seat) 16 inches, width 23.5 inches, depth 29 inches", {"seat_height": "16", "width": "23.5", "depth": "29"}),
    ("WA", 'Depth 1 3/4"  Width 31 7/8"  Height 78 3/4"', {"depth": "1.75", "width": "31.875", "height": "78.75"}),
    ("WA", "height 41¾in width 21¾in depth 2in", {"height": "41.75", "width": "21.75", "depth": "2"}),
    ("PB", "90” oah x 30”dia. shade", {"height": "90", "diameter": "30", "shade": "90,30"}),
    ("PB", 'seat 17"h', {"seat_height": "17"}),
    ("LIA", "Diam. 150x36 inch", {"diameter": "150", "height": "36"}),
    ("LIA", "20W x 30D x 40HT", {"width": "20", "depth": "30", "height": "40"}),
    ("SS", 'H: 9.0" W: 6.0" D: 6.5"', {"height": '9.0"', "width": '6.0"', "depth": '6.5"'}),
    ("SS", '4.5" Ø, 4.6" H', {"diameter": '4.5"', "height": '4.6"'}),
    ("AK", "first 9 dia x 8 h then 12 1/2 dia x 20 h", {"diameter": "12.5", "height": "20"}),
    ("NC", "20 DIA x 30D x 40H", {"diameter": "20", "depth": None, "height": "40"}),
    ("UM", "20 Dia x 30 H x 15 W", {"diameter": "20", "height": "30", "width": None}),
    ("VH", "12W x 11D x 21H x 99W", {"width": "99", "depth": "11"}),
    ("TRO", "12 W x 9 D%3Cbr%3E99 W", {"width": "12", "depth": "9"}),
    ("COL", "HEIGHT 100 MM\nWEIGHT 15 KG\nSHADE 12\"", {"height": "4", "weight": "33", "shade": "12"}),
    ("SB", '10" x 20"', {"length": "10", "width": "20"}),
    ("SB", '10" x 20" x 30" x 40"', {"length": "10", "width": "20", "depth": "30", "height": "40"}),
    ("SB", '60" L x 20" x 30"', {"length": "60", "width": "20", "depth": "30", "height": None}),
    ("SB", '30" DIA x 18 1/2" H', {"diameter": "30", "height": "18.5"}),
    ("AF", "Breadth - .5 | Projection: 9", {"width": "0.5", "depth": None}),
    ("PF", "L 100 x P 50 cm\nL 39,37 x P 19,7 inch", {"length": "39,37", "depth": "19,7"}),
    ("EIcm", "W=80", {"width": None}),
    ("EIcm", "W=80;H=40", {"width": "31.5", "height": "15.75"}),
    ("GB", 'Width: 32.75", 30"', {"width": "32.75"}),
    ("SUT", "Width: 30 in / 76 cm", {"width": "30"}),
    ("PAH", "Width: 29 1/4″", {"width": "29 1/4"}),
    ("HIC", "W 20 x D 30 x H 40, 50 high", {"height": "50"}),
    ("BEN", '72" x 36" x 30" D', {"length": "72", "width": "36", "depth": "30"}),
]


@pytest.mark.parametrize("code", sorted({c for c, _, _ in DIMS}))
def test_grammar(spark, code):
    cases = [(i, t, e) for i, (c, t, e) in enumerate(DIMS) if c == code]
    df = spark.createDataFrame([(i, t) for i, t, _ in cases], "i int, spec string")
    got = {r["i"]: r["dims"] for r in packs.extract_dimensions(df, "spec", code).collect()}
    for i, text, expected in cases:
        assert {f: got[i][f] for f in expected} == expected, text


def test_every_grammar_survives_odd_text(spark):
    odd = [None, "", "nan", "no numbers", '"', "x x x", "::", "1/0", "12", "Ø", "(((", "W", "9" * 40, "9" * 400 + '" W', "W. 1.2.3″ 4..5\" H x . D", "Width: .\nHeight: 1/0", "a\u00a0b", "$1 \\\\ $2 [", "x" * 20000]
    df = spark.createDataFrame([(t,) for t in odd], "spec string")
    for code in packs.PACKS:
        assert packs.extract_dimensions(df, "spec", code).count() == len(odd), code


def test_every_scalar_survives_odd_text(spark):
    odd = [None, "", "nan", '"', "1/0", "9" * 400, "1.2.3", ".", "$1 \\ $2 [", "%zz", "http://", "//", "?#&=", "x" * 20000, '{"a":', "<p", "a\u00a0b"]
    df = spark.createDataFrame([(t,) for t in odd], "v string")
    for fn in {fn for fn, _, _ in SCALARS}:
        assert len(df.select(fn(F.col("v")).alias("o")).collect()) == len(odd)
    rest = [attrs.measure_map, attrs.finish_options, attrs.canopy_parts, lines.caps_sections, lines.label_pairs, P.row_pairs, P.section_map, P.embedded_product, N.to_decimal, N.typed_number, N.count_from_text, A.nearest_miles]
    groups = [attrs.com_col, attrs.upholstery, attrs.electrical, attrs.pipe_fields, attrs.rug_fields, lines.sheet_attributes, lines.ordered_line_rules, lines.pipe_attributes, P.source_facts, P.technical_specs, P.bold_facts]
    for fn in rest:
        assert len(df.select(fn(F.col("v")).alias("o")).collect()) == len(odd)
    for fn in groups:
        assert len(df.select(*[c.alias(k) for k, c in fn(F.col("v")).items()]).collect()) == len(odd)


def test_section_headings(evaluate):
    text = "Finish: brass\nGlass\nLamping\nE26\nFinish\nnickel"
    s = lambda h: lambda c: lines.sections(c, ["Finish", "Lamping", "Mounting"])[h]
    assert evaluate(s("Finish"), text) == "nickel"
    assert evaluate(s("Lamping"), text) == "E26"
    assert evaluate(s("Mounting"), text) is None


def test_dimension_label_needs_inches(spark):
    df = spark.createDataFrame([(1, 'Height: 30 cm\nHeight: 12"\nWidth: 30 cm\nChain Length: 6 feet\nSocket: E26')], "id int, spec string")
    got = {r["label"]: r["value"] for r in lines.final_values(lines.label_table(df, "id", "spec"), "id").collect()}
    assert got == {"Height": '12"', "Chain Length": "6 feet", "Socket": "E26"}


def test_clash_suffix():
    assert free_name("Width", {"Width"}) == "Width (2)"
    assert free_name("Width", {"Width", "Width (2)"}) == "Width (3)"
    assert free_name("Depth", {"Width"}) == "Depth"


def test_finish_validity(evaluate):
    ok = [evaluate(filters.valid_finish, v) for v in ("Aged Brass", "Brass 2", "a/b", "STR1", "Select one", "one two three four", "x" * 30, "")]
    assert ok == [True] + [False] * 7


def test_trackers_in_fixed_order(evaluate):
    html = "<script src='https://static.hotjar.com/c/hotjar-1'></script> GTM-ABC fbq('init')"
    assert evaluate(audit.trackers, html) == ["Google Tag Manager", "Meta Pixel", "Hotjar"]
