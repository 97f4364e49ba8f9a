import pytest
from pyspark.sql import functions as F

from sedimark.operators.packed import PackedField, packed_values, unpack

TAXONOMY, NAMES, OBJECTS = PackedField("t"), PackedField("t", blank_separates=True), PackedField("t", kept=";", member="taxonomy")

CASES = [
    (TAXONOMY, None, []), (TAXONOMY, "", []), (TAXONOMY, " \t ", []), (TAXONOMY, "one", [(1, "one")]),
    (TAXONOMY, "a;b;", [(1, "a"), (2, "b")]), (TAXONOMY, " a ; b > c ", [(1, "a"), (2, "b"), (3, "c")]),
    (TAXONOMY, "a, , c", [(1, "a"), (3, "c")]), (TAXONOMY, "a\tb\r\nc\n\nd", [(1, "a"), (2, "b"), (3, "c"), (5, "d")]),
    (TAXONOMY, "a b-c_d.e:f(g)", [(1, "a b-c_d.e:f(g)")]),
    (TAXONOMY, 'x;"y ""q"", z"', [(1, "x"), (2, 'y "q", z')]), (TAXONOMY, r"x\, y;z", [(1, "x, y"), (2, "z")]),
    (TAXONOMY, r'["a", "b \"c\", d", "é\\", ""]', [(1, "a"), (2, 'b "c", d'), (3, "é\\")]),
    (TAXONOMY, '["a", null, "b"]', [(1, "a"), (3, "b")]), (TAXONOMY, "['a; b', 'c']", [(1, "a; b"), (2, "c")]),
    (TAXONOMY, "[a, b]", [(1, "a"), (2, "b")]), (TAXONOMY, '"open;b', [(1, '"open'), (2, "b")]), (TAXONOMY, "O'Neil;x'y", [(1, "O'Neil"), (2, "x'y")]),
    (TAXONOMY, '0;"q;r"', [(1, "0"), (2, "q;r")]), (TAXONOMY, ";".join("v%d" % i for i in range(3000)), [(i + 1, "v%d" % i) for i in range(3000)]),
    (NAMES, "16S 18S", [(1, "16S"), (2, "18S")]), (NAMES, "16S & junk", [(1, "16S"), (2, "junk")]), (NAMES, "16S;;18S", [(1, "16S"), (3, "18S")]),
    (NAMES, '"a (copy; trimmed)" b', [(1, "a (copy; trimmed)"), (2, "b")]),
    (OBJECTS, "A;B | C;D", [(1, "A;B"), (2, "C;D")]), (OBJECTS, '["A;B","C"]', [(1, "A;B"), (2, "C")]),
    (OBJECTS, '[{"taxonomy": "A;B", "z": "q"}, null, {"z": "taxonomy", "taxonomy": "C {x}, y"}]', [(1, "A;B"), (3, "C {x}, y")]),
    (OBJECTS, '[{"z": "q"}, {"taxonomy": null}]', []),
]


@pytest.fixture(scope="module")
def answers(spark):
    answer = {}
    for field in (TAXONOMY, NAMES, OBJECTS):
        texts = list(dict.fromkeys(t for f, t, _ in CASES if f == field))
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        for r in df.select("t", packed_values(F.col("t"), field).alias("v")).collect():
            answer[field, r.t] = [(v.pos, v.value) for v in r.v]
    return answer


@pytest.mark.parametrize("field, text, expected", CASES, ids=range(len(CASES)))
def test_values(answers, field, text, expected):
    assert answers[field, text] == expected


def test_rows_repeat_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a;b", "x", 9), (1, "a;b", "y", 9), (2, None, "z", 9)], "row_id long, t string, value string, pos int")
    rows = sorted(tuple(r) for r in unpack(df, [TAXONOMY]).collect())
    assert rows == [("t", 1, 1, "a"), ("t", 1, 1, "a"), ("t", 1, 2, "b"), ("t", 1, 2, "b")]
    assert unpack(df.limit(0), [TAXONOMY]).count() == 0


NEVER, LINES = set("-_.:()'\"\\"), set("\t\n\x0b\f\r\x85  ")


def scanned(text, field):
    """The values of a text, read character by character."""
    import json
    import unicodedata

    text = (text or "").strip()
    if not text:
        return []
    listed = text.startswith("[") and text.endswith("]")
    if listed and field.member and "{" in text:
        entries = json.loads(text)
        values = [e.get(field.member) if isinstance(e, dict) else e for e in entries]
        return [(i + 1, v.strip()) for i, v in enumerate(values) if v and v.strip()]
    body = text[1:-1] if listed else text
    body = body.strip() if field.blank_separates else body
    parts, now, quoted, i = [], "", False, 0

    def separates(c):
        return c in LINES or (c not in NEVER and c not in field.kept and unicodedata.category(c)[0] in "PS")

    def close():
        nonlocal now, quoted
        parts.append("" if listed and not quoted and now.strip() in ("null", "None") else now.strip())
        now, quoted = "", False

    while i < len(body):
        c = body[i]
        before = body[i - 1] if i else " "
        if c in "\"'" and not (before.isalpha() or unicodedata.category(before)[0] == "N" or before in "_.()-"):
            j, held = i + 1, ""
            while j < len(body):
                if body[j] == "\\" and j + 1 < len(body):
                    held += {"n": "\n", "t": "\t"}.get(body[j + 1], body[j + 1]) if c == '"' else body[j + 1]
                    j += 2
                elif body[j] == c and body[j + 1:j + 2] == c:
                    held, j = held + c, j + 2
                elif body[j] == c:
                    break
                else:
                    held, j = held + body[j], j + 1
            if j < len(body):
                if c == '"' and "\\u" in body[i:j]:
                    held = json.loads(body[i:j + 1])
                now, quoted, i = now + held, True, j + 1
                continue
        if c == "\\" and i + 1 < len(body):
            now, i = now + body[i + 1], i + 2
            continue
        if separates(c):
            close()
            i += 2 if body[i:i + 2] == "\r\n" else 1
            while i < len(body) and field.blank_separates and unicodedata.category(body[i]) == "Zs":
                i += 1
            continue
        if field.blank_separates and unicodedata.category(c) == "Zs":
            j = i
            while j < len(body) and unicodedata.category(body[j]) == "Zs":
                j += 1
            if not (j < len(body) and separates(body[j])):
                close()
            i = j
            continue
        now, i = now + c, i + 1
    close()
    return [(k + 1, v) for k, v in enumerate(parts) if v]


def test_whole_tables_against_a_scanner(spark):
    from pathlib import Path

    from sedimark.plans.problems import PREFERRED_FIELDS, SEQUENCE_FIELDS

    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    for name, fields in (("sequences", SEQUENCE_FIELDS), ("preferred_taxonomy", PREFERRED_FIELDS)):
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        expected = sorted((f.name, r["row_id"], p, v) for r in df.collect() for f in fields for p, v in scanned(r[f.name], f))
        assert sorted(tuple(r) for r in unpack(df, fields).collect()) == expected and len(expected) > 100
