import hashlib
import random
import re

import numpy as np
import pytest
from llm_oracle import same

from strataforge.llm import fim
from strataforge.llm.queries import op11_fill_in_middle, oracle_sql

PATTERN = {"char": r"(?s).", "word": r"(?s)^[\t-\r ]+(?=[^\t-\r ])|[^\t-\r ]+[\t-\r ]*|^[\t-\r ]+$", "line": r"(?s)[^\n]*\n|[^\n]+"}


def plain_cut(text, one, two, unit):
    """Brute force: the units as a list."""
    units = re.findall(PATTERN[unit], text)
    assert "".join(units) == text
    a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
    return len(units), a, b, len("".join(units[:a]).encode()), len("".join(units[:b]).encode())


@pytest.mark.parametrize("unit", sorted(fim.UNITS))
@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64, 1 << 16])
def test_chunks_of_any_size_find_the_places_of_brute_force(unit, chunk):
    rnd = random.Random(chunk)
    texts = ["", "a", "é", "\n", " ", "  ab", "ab  ", "日本語 text\n\nüber 👩‍👩‍👧 x", *("".join(rnd.choices("ab é日👧\n\t", k=rnd.randrange(60))) for _ in range(200))]
    draws = np.array([[rnd.randrange(1 << 32), rnd.randrange(1 << 32)] for _ in texts], np.int64)
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)]).astype(np.int64)
    got = fim.cut_places(np.frombuffer(b"".join(data), np.uint8), bounds, draws, unit, chunk)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == [plain_cut(t, *d, unit) for t, d in zip(texts, draws.tolist(), strict=True)]


def test_query_equals_sql_on_whole_tables(spark, sf):
    same(op11_fill_in_middle(spark, sf), oracle_sql()["op11_fill_in_middle"], sf)


def by_hand(i, text):
    text = text or ""
    hexes = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexes[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= 90:
        return i, n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (i, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (i, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "x"), (None, "no id"), (5, "has <S> in it"), (6, "<P"), (7, "<S<S"), (8, "M>é<"), (9, "日本" * 100_000), (9, "日本" * 100_000), (10, "\x00\r\n")]
    rows += [(i, "ends in <S" + "é👧 "[i % 3] * (i % 5) + "<P") for i in range(11, 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS n", "1 AS form", "2 AS output", "3 AS _text", "4 AS _cut")
    got = fim.transformed(df, chunk=1000)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(by_hand(*r)) for r in rows)
    back = got.select("doc_id", fim.restored(got.output, got.form).alias("t")).collect()
    assert sorted((repr(r.doc_id), r.t) for r in back) == sorted((repr(i), t or "") for i, t in rows)
    assert fim.digests(df.limit(0)).count() == 0


def test_text_ids_and_other_units(spark):
    df = spark.createDataFrame([("a b", "one two  three\nfour"), ("c", "1\n2\n3\n")], "key string, body string")
    for unit in fim.UNITS:
        for r in fim.transformed(df, "key", "body", unit, plain=0).withColumn("t", fim.restored(fim.F.col("output"), fim.F.col("form"))).collect():
            assert r.t == {"a b": "one two  three\nfour", "c": "1\n2\n3\n"}[r.key]
    with pytest.raises(ValueError):
        fim.transformed(df, "key", "body", "syllable")
    with pytest.raises(ValueError):
        fim.transformed(df, "key", "body", marks=("ab", "ba", "<M>"))
    with pytest.raises(ValueError):
        fim.transformed(df, "key", "body", marks=("<a", "<abc", "<M>"))
