"""Fill-in-the-middle: texts are cut at two ranks among their units and the parts set in another order.

Units (code points, words with the gap after them, lines) are told from adjacent bytes of UTF-8: UNITS says of two neighbours
whether a unit starts at the right one. So a text can be read in chunks of CHUNK bytes that overlap by one byte, each on its own:

1. every chunk of every text of a batch counts the units that start in it;
2. prefix sums over those counts give each text's number of units, the two cut ranks (by hashes of the id) and the chunk that
   each rank falls into;
3. only those chunks are scanned again, for the byte at which the unit of that rank starts.

The task that reads a row does this, as no part of it needs another row: nothing is shuffled, and a very long text costs memory
for a chunk's flags only. Cutting and joining the bytes at the two places is done by Spark's own expressions. A part is never
searched for its end: rebuilding looks for the first middle or suffix mark, which texts that hold a mark do not get (they stay plain).

Forms: plain, the text as it is; psm, prefix, suffix, middle; spm, suffix, prefix, middle; each part behind its mark.

Edge cases: a null text counts as empty; an empty text, or one that contains a mark, is plain; a null id hashes as no digits;
equal ids get equal hashes, whatever their texts; a rank equal to the number of units is the end of the text; repeated rows get
equal results; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


CHUNK = 1 << 16
MARKS = ("<P>", "<S>", "<M>")
#: Percents of texts that stay plain, and of the others that put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20


def _gap(byte: np.ndarray) -> np.ndarray:
    return (byte == 32) | ((byte >= 9) & (byte <= 13))


#: Of two neighbouring bytes, whether a unit starts at the right one. The first byte of a text always starts one.
UNITS = {
    "char": lambda left, right: (right & 0xC0) != 0x80,
    "word": lambda left, right: _gap(left) & ~_gap(right),
    "line": lambda left, right: left == 10,
}


def _starts(data: np.ndarray, at: int, stop: int, begin: int, unit: str) -> np.ndarray:
    """Flags of data[at:stop]; the chunk reads the byte before it too, unless the text begins with it."""
    inner = UNITS[unit](data[max(at - 1, begin) : stop - 1], data[max(at, begin + 1) : stop])
    return np.concatenate([[True], inner]) if at == begin else inner


def cut_places(data: np.ndarray, bounds: np.ndarray, draws: np.ndarray, unit: str, chunk: int = CHUNK) -> tuple[np.ndarray, ...]:
    """data: the bytes of all texts, text i being data[bounds[i]:bounds[i + 1]]; draws: two numbers of each text. Gives each text's
    number of units, its two ranks in order, and the bytes of the text before each."""
    begin, end = bounds[:-1], bounds[1:]
    chunks = -(-(end - begin) // chunk)
    text = np.repeat(np.arange(len(begin)), chunks)
    at = begin[text] + (np.arange(len(text)) - (np.cumsum(chunks) - chunks)[text]) * chunk
    stop = np.minimum(at + chunk, end[text])
    counts = np.fromiter((np.count_nonzero(_starts(data, a, b, c, unit)) for a, b, c in zip(at, stop, begin[text], strict=True)), np.int64, len(text))
    before = np.cumsum(counts) - counts  # units of the batch before each chunk
    units = np.bincount(text, counts, len(begin)).astype(np.int64)
    first = np.cumsum(units) - units
    ranks = np.sort(draws % (units[:, None] + 1), axis=1)
    places = np.repeat((end - begin)[:, None], 2, axis=1)
    rows, side = np.nonzero(ranks < units[:, None])
    wanted = first[rows] + ranks[rows, side]
    owner = np.searchsorted(before, wanted, "right") - 1
    for r, s, w, k in zip(rows, side, wanted, owner, strict=True):
        places[r, s] = at[k] - begin[r] + np.flatnonzero(_starts(data, at[k], stop[k], begin[r], unit))[w - before[k]]
    return units, ranks[:, 0], ranks[:, 1], places[:, 0], places[:, 1]


def _cuts(unit: str, chunk: int):
    names = ["n", "rank1", "rank2", "byte1", "byte2"]

    @F.arrow_udf(", ".join(f"{x} long" for x in names))
    def cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        text = text.cast(pa.large_binary())
        bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        held = text.buffers()[2] if len(text) else None
        data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
        draws = np.stack([one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)], axis=1)
        return pa.StructArray.from_arrays([pa.array(x) for x in cut_places(data, bounds, draws, unit, chunk)], names)

    return cuts


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS, chunk: int = CHUNK) -> DataFrame:
    """A row for each row: the id, n (units), form, prefix_units, middle_units (null if plain), output."""
    if unit not in UNITS:
        raise ValueError(f"units are {sorted(UNITS)}")
    if len(set(marks)) < 3 or not all(marks) or any(m[k:] == other[: len(m) - k] for m in marks for other in marks for k in range(1, len(m))) or any(m != other and m in other for m in marks for other in marks):
        raise ValueError("marks differ, none is in another or begins with the end of one")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), digest.alias("_digest"))
    draw = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    is_plain = (F.col("_text") == "") | (draw[2] % 100 >= 100 - plain)
    for m in marks:
        is_plain = is_plain | F.contains("_text", F.lit(m))
    form = F.when(is_plain, "plain").when(draw[3] % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.select(id_col, "_text", form.alias("form"), _cuts(unit, chunk)(F.col("_text"), draw[0], draw[1]).alias("_cut"))
    data, one, two = F.col("_text").cast("binary"), F.col("_cut.byte1").cast("int"), F.col("_cut.byte2").cast("int")

    def part(start: Column, stop: Column) -> Column:
        return F.substring(data, start + 1, stop - start).cast("string")

    prefix, middle, suffix = part(F.lit(0), one), part(one, two), part(two, F.octet_length("_text"))
    p, s, m = map(F.lit, marks)
    output = F.when(F.col("form") == "plain", F.col("_text")).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.concat(p, prefix, s, suffix, m, middle))
    cut = F.col("form") != "plain"
    return rows.select(
        id_col, F.col("_cut.n").alias("n"), "form",
        F.when(cut, F.col("_cut.rank1")).alias("prefix_units"), F.when(cut, F.col("_cut.rank2") - F.col("_cut.rank1")).alias("middle_units"), output.alias("output"),
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text again, from an output and its form alone."""
    p, s, m = marks

    def taken(text: Column, mark: str) -> tuple[Column, Column]:
        """What stands before the first mark, and what after it."""
        head = F.substring_index(text, mark, 1)
        return head, F.substring(text.cast("binary"), F.octet_length(head) + len(mark.encode()) + 1, F.octet_length(text)).cast("string")

    psm_prefix, rest = taken(taken(output, p)[1], s)
    psm_suffix, psm_middle = taken(rest, m)
    spm_suffix, rest = taken(taken(output, s)[1], p)
    spm_prefix, spm_middle = taken(rest, m)
    return F.when(form == "plain", output).when(form == "spm", F.concat(spm_prefix, spm_middle, spm_suffix)).otherwise(F.concat(psm_prefix, psm_middle, psm_suffix))


def digests(docs: DataFrame) -> DataFrame:
    """The query's columns: lengths and digests of outputs and of the texts rebuilt from them."""
    out = transformed(docs)
    return out.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def digests_sql() -> str:
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
    h AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
                 CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {100 - PLAIN} THEN 'plain'
                      WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM h),
    o AS (SELECT *, CASE form WHEN 'plain' THEN t
                 WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1, n - b) || '<M>' || substring(t, a + 1, b - a)
                 ELSE '<S>' || substring(t, b + 1, n - b) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) END AS output FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(output) AS output_sha256, sha256(t) AS restored_sha256 FROM o
    """
