"""Checks between layers: every rule is a filter, an anti-join or a window; messages are rows.

Keys are read through aliases and chapters in one spelling, so clean data is silent. Anti-joins never broadcast by hint: Spark
picks by size and splits skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.text import chapter_key, nonempty, token_count
from strataforge.functions.vectors import not_finite

# Required fields of the layers, aliases of fields, order of severities and validators.
REQUIRED = {
    10: ("document_id", "source_id", "domain", "hash", "lineage"),
    20: ("chapter_id", "document_id", "source_id", "heading", "sequence"),
    30: ("chunk_id", "chapter_id", "document_id", "token_count", "sequence"),
    40: ("evidence_id", "chunk_id", "confidence", "source_references"),
    50: ("embedding_id", "chunk_id", "evidence_id", "domain", "model_version", "vector"),
}
ALIASES = {
    "hash": ("hash", "hash_sha256"),
    "lineage": ("lineage", "lineage_layer00_path"),
    "chapter_id": ("chapter_id", "chapter"),
    "heading": ("heading", "title"),
    "sequence": ("sequence", "chapter"),
    "confidence": ("confidence", "score"),
    "source_references": ("source_references", "lineage", "source_file"),
}
SEVERITIES = ("INFO", "WARNING", "ERROR", "FATAL")
VALIDATORS = ("lineage", "metadata", "references", "size")
TRANSITIONS = {"10_to_20": (10, 20), "20_to_30": (20, 30), "30_to_40": (30, 40), "40_to_50": (40, 50)}
CHUNK_FIELDS = ("chunk_id", "document_id", "chapter_id", "source_id", "domain", "topic", "sequence", "token_count", "source_file", "created_at", "updated_at", "hash_sha256", "lineage")
MIN_TOKENS, MAX_TOKENS = 100, 500


def field(df: DataFrame, name: str) -> Column:
    """A field through its aliases as text, empty if none is there."""
    kinds = dict(df.dtypes)
    found = [F.to_json(c) if kinds[c].startswith(("struct", "array", "map")) else F.col(c).cast("string") for c in ALIASES.get(name, (name,)) if c in kinds]
    value = nonempty(*found) if found else F.lit("")
    return F.when(value == "", value).otherwise(chapter_key(value)) if name == "chapter_id" else value


def keyed(df: DataFrame) -> DataFrame:
    """All known key fields of a layer as text columns, with `file`."""
    names = ("document_id", "source_id", "chapter_id", "chunk_id", "evidence_id", "embedding_id", "source_references")
    file = F.coalesce(*(F.col(c) for c in ("file", "file_name", "source_file") if c in df.columns), F.lit(""))
    return df.select(*(field(df, n).alias(n) for n in names), file.alias("file"))


def message(df: DataFrame, transition: str, validator: str, identifier: Column, rule: str, description: Column | str, severity: str) -> DataFrame:
    text = F.lit(description) if isinstance(description, str) else description
    file = F.col("file") if "file" in df.columns else F.lit("")
    return df.select(F.lit(transition).alias("transition"), F.lit(validator).alias("validator"), identifier.cast("string").alias("identifier"), file.alias("file"), F.lit(rule).alias("rule"), text.alias("description"), F.lit(severity).alias("severity"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unresolved(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in known; a row with an empty first key refers to nothing."""
    return rows.filter(F.col(keys[0]).cast("string") != "").join(known.select(*keys).distinct(), keys, "left_anti")


def repeated(rows: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The second and later rows of a key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") > 1).drop("place")


def lineage(transition: str, before: DataFrame, after: DataFrame) -> DataFrame:
    old, new = keyed(before), keyed(after)
    needs = {"10_to_20": ("source_id", "document_id", "chapter_id"), "20_to_30": ("document_id", "chapter_id", "chunk_id"), "30_to_40": ("evidence_id", "chunk_id"), "40_to_50": ("embedding_id", "evidence_id", "chunk_id")}[transition]
    say = lambda df, ident, text: message(df, transition, "lineage", ident, "lineage", text, "ERROR")
    parts = [say(new.filter(F.col(c) == ""), F.lit(c), f"missing {c}") for c in needs]
    if transition == "10_to_20":
        parts.append(say(unresolved(new, old, ["document_id"]), F.col("document_id"), "document_id not found in layer10"))
        key, what, has = F.concat_ws(":", "document_id", "chapter_id"), "duplicate chapter_id within document", "chapter_id"
    else:
        has = {"20_to_30": "chunk_id", "30_to_40": "evidence_id", "40_to_50": "embedding_id"}[transition]
        key, what = F.col(has), f"duplicate {has}"
    parts.append(say(repeated(new.filter(F.col(has) != ""), key, ["file", "chunk_id"]), key, what))
    return union(parts)


def metadata(transition: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Required fields that are empty, on both sides; one pass a side, a row a missing field."""
    parts = []
    for layer, df in zip(TRANSITIONS[transition], (before, after), strict=True):
        missing = F.filter(F.array(*(F.when(field(df, n) == "", F.lit(n)) for n in REQUIRED[layer])), lambda x: x.isNotNull())
        file = F.coalesce(*(F.col(c) for c in ("file", "file_name", "source_file") if c in df.columns), F.lit(""))
        rows = df.select(file.alias("file"), F.explode(missing).alias("name"))
        parts.append(message(rows, transition, "metadata", F.col("name"), "required_field", F.concat(F.lit(f"layer{layer}: missing required field "), "name"), "ERROR"))
    return union(parts)


def references(transition: str, before: DataFrame, after: DataFrame) -> DataFrame:
    old, new = keyed(before), keyed(after)
    say = lambda df, ident, rule, text, severity="FATAL": message(df, transition, "references", ident, rule, text, severity)
    if transition == "10_to_20":
        return say(unresolved(new, old, ["document_id"]), F.col("document_id"), "reference_document", "document reference unresolved")
    if transition == "20_to_30":
        pair = ["document_id", "chapter_id"]
        return say(new.join(old.select(*pair).distinct(), pair, "left_anti"), F.concat_ws(":", *pair), "reference_chapter", "chapter reference unresolved")
    parts = [say(unresolved(new, old, ["chunk_id"]), F.col("chunk_id"), "reference_chunk", "chunk reference unresolved")]
    if transition == "30_to_40":
        return union([*parts, say(new.filter(F.col("source_references") == ""), nonempty("chunk_id", F.lit("source_references")), "reference_source", "source references missing", "ERROR")])
    parts.append(say(unresolved(new, old, ["evidence_id"]), F.col("evidence_id"), "reference_evidence", "evidence reference unresolved"))
    for key, what in (("chunk_id", "chunk"), ("evidence_id", "evidence")):
        parts.append(say(unresolved(old.select(key).distinct(), new, [key]), F.col(key), f"coverage_{what}", f"missing embedding for {what} from layer40", "ERROR"))
    return union(parts)


def sizes(transition: str, after: DataFrame, least: int = MIN_TOKENS, most: int = MAX_TOKENS) -> DataFrame:
    layer = TRANSITIONS[transition][1]
    file = F.coalesce(*(F.col(c) for c in ("file", "file_name", "source_file") if c in after.columns), F.lit(""))
    rows = after.withColumn("file", file)
    say = lambda df, ident, rule, text, severity: message(df, transition, "size", ident, rule, text, severity)
    if layer == 20:
        return say(rows.filter(token_count(F.col("body")) == 0), F.col("file"), "size_chapter_non_empty", "chapter body is empty", "ERROR")
    if layer == 30:
        body = token_count(F.coalesce(next((F.col(c) for c in ("body", "content", "text") if c in rows.columns), F.lit("")), F.lit("")))
        n, ident = F.coalesce(F.expr("try_cast(token_count AS BIGINT)") if "token_count" in rows.columns else F.lit(None), body), nonempty(F.col("chunk_id").cast("string"), F.col("file"))
        return union([
            say(rows.filter(n < least), ident, "size_chunk_min", F.concat(F.lit("chunk below minimum token threshold ("), n.cast("string"), F.lit(f" < {least})")), "WARNING"),
            say(rows.filter(n > most), ident, "size_chunk_max", F.concat(F.lit("chunk above maximum token threshold ("), n.cast("string"), F.lit(f" > {most})")), "ERROR"),
        ])
    if layer == 40:
        return say(rows.filter(F.trim(F.coalesce("content_preview", F.lit(""))) == ""), nonempty(F.col("evidence_id").cast("string"), F.col("file")), "size_evidence_content", "evidence preview empty", "WARNING")
    return vector_rules(rows)


def vector_rules(rows: DataFrame, key: str = "embedding_id", vector: str = "vector", model: str = "model_version") -> DataFrame:
    """Vectors must be there, finite, and have the length and model of the first by key. The expectation is one row (min_by)."""
    first = lambda c, has: F.min_by(F.when(has, c), F.when(has, F.col(key)))
    has_model, has_vector = F.coalesce(model, F.lit("")) != "", F.size(F.coalesce(vector, F.array().cast("array<double>"))) > 0
    expected = rows.agg(first(F.col(model), has_model).alias("model"), first(F.size(vector), has_vector).alias("dimension")).first()
    odd = F.array_position(F.transform(vector, lambda x: not_finite(F.array(x))), True)  # the first that is not finite
    say = lambda df, rule, text: message(df, "40_to_50", "size", F.col(key), rule, text, "ERROR")
    return union([
        # Rule names and texts.
        say(rows.filter(~has_model), "embedding_model_version", "model_version missing"),
        say(rows.filter(has_model & (F.col(model) != F.lit(expected.model))), "embedding_model_version_consistency", F.concat(F.lit("inconsistent model_version '"), model, F.lit(f"' (expected '{expected.model}')"))),
        say(rows.filter(F.col(vector).isNull()), "embedding_vector_type", "vector is not a list"),
        say(rows.filter(F.size(vector) == 0), "embedding_vector_non_empty", "vector is empty"),
        say(rows.filter(has_vector & (F.size(vector) != F.lit(expected.dimension))), "embedding_vector_dimension_consistency", F.concat(F.lit("inconsistent vector dimension "), F.size(vector).cast("string"), F.lit(f" (expected {expected.dimension})"))),
        say(rows.filter(has_vector & (odd > 0)), "embedding_vector_finite", F.concat(F.lit("vector element at index "), (odd - 1).cast("string"), F.lit(" is not finite"))),
    ])


def chunk_metadata(chunks: DataFrame, least: int = MIN_TOKENS, most: int = MAX_TOKENS) -> DataFrame:
    """Chunk-level errors and warnings, where a chunk above the maximum is a warning."""
    missing = F.array_except(F.array(*(F.lit(c) for c in CHUNK_FIELDS)), F.array(*(F.lit(c) for c in chunks.columns)))
    n = F.col("token_count")
    errors = F.array(F.when(F.size(missing) > 0, F.concat(F.lit("missing_fields: "), F.array_join(F.array_sort(missing), ", "))), F.when(n < 1, F.lit("token_count must be > 0")))
    warnings = F.array(F.when(n < least, F.lit("token_count below minimum")), F.when(n > most, F.lit("token_count above maximum")))
    return chunks.select("chunk_id", F.array_compact(errors).alias("errors"), F.array_compact(warnings).alias("warnings"))


def sequence_breaks(rows: DataFrame, group: str, sequence: str, start: int = 1) -> DataFrame:
    """Rows whose sequence is not start, start + 1, ... within their group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(sequence)) + (start - 1)
    return rows.withColumn("expected", place).filter(F.col(sequence) != F.col("expected"))


def overlaps(rows: DataFrame, group: str, order: str, start: str, end: str) -> DataFrame:
    """Rows that start before the row before them ends."""
    before = F.lag(end).over(Window.partitionBy(group).orderBy(order))
    return rows.withColumn("previous_end", before).filter(F.col(start) < F.col("previous_end"))


def validate(transition: str, before: DataFrame, after: DataFrame, least: int = MIN_TOKENS, most: int = MAX_TOKENS, only: tuple[str, ...] = VALIDATORS) -> DataFrame:
    """All messages of a transition, by the validators that are switched on."""
    run = {"lineage": lambda: lineage(transition, before, after), "metadata": lambda: metadata(transition, before, after), "references": lambda: references(transition, before, after), "size": lambda: sizes(transition, after, least, most)}
    return union([run[v]() for v in VALIDATORS if v in only])


def severity_rank(severity: Column) -> Column:
    return F.array_position(F.array(*(F.lit(s) for s in SEVERITIES)), severity)


def summary(messages: DataFrame, checked: int) -> DataFrame:
    """Per validator: checked, failed, passed and the worst severity."""
    failed = F.count_if(F.col("severity").isin("ERROR", "FATAL"))
    return messages.groupBy("validator").agg(F.lit(checked).alias("checked"), failed.alias("failed"), F.greatest(F.lit(0), F.lit(checked) - failed).alias("passed"), F.max_by("severity", severity_rank(F.col("severity"))).alias("worst"))


def blocks(messages: DataFrame, fail_on_warning: bool = False, stop_on_error: bool = True) -> bool:
    """Whether the transition must not be passed; stops reading at the first message that says so."""
    least = 2 if fail_on_warning else 3
    return stop_on_error and not messages.filter(severity_rank(F.col("severity")) >= least).limit(1).isEmpty()


def ordered(messages: DataFrame) -> DataFrame:
    """Messages in the order in which people read them."""
    return messages.orderBy("file", "identifier", "rule", "description", "severity")
