from sedimark.operators.rejects import classified_headers, classified_lines

PR2 = "AB1.1.7.90_U|18S_rRNA|nucleus||Eukaryota|a|b|c|d|e|f|g|h"
HEADERS = [
    ("PR2", PR2, None), ("PR2", ">" + PR2, None), ("PR2", PR2 + "|x", "field_count"), ("PR2", PR2.replace("18S_rRNA", "18S"), "gene"),
    ("PR2", PR2.replace("Eukaryota", " "), "domain"), ("PR2", PR2.replace("_U", "_"), "identifier"), ("PR2", PR2.replace(".90", ".x"), "identifier"),
    ("SILVA", "AB1.1.9 Bacteria;X", None), ("SILVA", ">AB1 Bacteria", None), ("SILVA", "AB1 ; ;", "lineage"), ("SILVA", " Bacteria", "identifier"), ("SILVA", "AB1", "identifier"),
    ("IMG", "IMG_33.a_1 x", None), ("IMG", "IMG_33", None), ("IMG", "IMG_33|b", None), ("IMG", "IMG_33x", "identifier"), ("IMG", "xIMG_33", "identifier"),
    ("SILVA", None, "empty_header"), ("SILVA", " \t", "empty_header"), ("SILVA", ">", "empty_header"), (None, "AB1 x", "unknown_source"), ("X", "AB1 x", "unknown_source"),
]
SILVA = "AB1.1.9 Bacteria;X"
LINES = [
    (f"AB1.1.9,7.1,16S,12,{SILVA}", None), (f'"AB1.1.9","7.1","16S","0012",">{SILVA}"', None), ('AB1.1.9,7.1,18S,5,"AB1.1.9 Bacteria;str. ""K"", x"', None),
    (None, "empty_line"), ("  ", "empty_line"), (f"AB1.1.9,7.1,16S,12,{SILVA},x", "field_count"), (f"AB1.1.9,7.1,16S,{SILVA}", "field_count"),
    (f'AB1.1.9,7.1,16S,12,"{SILVA}', "quoting"), (f'AB1.1.9,7.1,16S,12,AB1.1.9 Bact"eria"', "quoting"), (f'"AB1.1.9" ,7.1,16S,12,{SILVA}', "quoting"),
    (f"AB1.1.9,7..1,16S,12,{SILVA}", "version"), (f"AB1.1.9,7.1,61S,12,{SILVA}", "marker"), (f"AB1.1.9,7.1,16S,0,{SILVA}", "length"), (f"AB1.1.9,7.1,16S,-3,{SILVA}", "length"),
    (f"AB1.1.9,7.1,16S,{'9' * 30},{SILVA}", None), (f"AB2,7.1,16S,12,{SILVA}", "identifier_mismatch"), ("AB1.1.9,7.1,16S,12,", "header:empty_header"), ("AB1,7.1,16S,12,AB1", "header:identifier"),
    (f"AB1.1.9,7.1,16S,12,AB1.1.9 {'x;' * 40000}", None),
]


def test_headers(spark):
    df = spark.createDataFrame([(i, s, h, "clash") for i, (s, h, _) in enumerate(HEADERS)], "row_id long, reference_source string, original_header string, reason string")
    rows = {r.row_id: r for r in classified_headers(df).collect()}
    assert [rows[i].reason for i in range(len(HEADERS))] == [r for *_, r in HEADERS]
    assert (rows[0].identifier, rows[0].taxonomy) == ("AB1.1.7.90_U", "Eukaryota;a;b;c;d;e;f;g;h")
    assert (rows[7].identifier, rows[7].taxonomy) == ("AB1.1.9", "Bacteria;X") and rows[2].identifier is None
    assert classified_headers(df.limit(0)).count() == 0


def test_lines(spark):
    df = spark.createDataFrame([(i, "SILVA", x, "clash") for i, (x, _) in enumerate(LINES)], "row_id long, reference_source string, line string, corrupt string")
    rows = {r.row_id: r for r in classified_lines(df.unionByName(df)).collect()}
    assert [rows[i].reason for i in range(len(LINES))] == [r for _, r in LINES]
    assert (rows[1].identifier, rows[1].length, rows[1].raw) == ("AB1.1.9", 12, None)
    assert rows[2].taxonomy == 'Bacteria;str. "K", x' and rows[7].raw == LINES[7][0]
    assert classified_lines(df.limit(0)).count() == 0
