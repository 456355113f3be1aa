"""The registered query of each operator: the operator over its whole table
with production parameters, and the digest columns of its contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    exact_dedup, language_id, lattice_lm, lexical_search, licenses, line_dedup, mixing, periodic_runs, quality,
    sentencepiece_fst, simhash, tool_calls, toxicity)
from tablewright.llm.common import table


#: Schemas of the tools that ``tool_turns`` derives.
SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 250}}},
    "classify": {"type": "object", "required": ["text", "labels"], "additionalProperties": False, "properties": {
        "text": {"type": "string"}, "threshold": {"type": "number", "minimum": 0, "maximum": 1},
        "labels": {"type": "array", "minItems": 1, "items": {"type": "string"}}}},
}


def tool_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that ``conversations`` stands for, as its turns name
    no tools. An assistant's turn is a call whose arguments carry its text; a
    turn of another role is the result of the turn before, and an orphan where
    that is no assistant's. A call needs the call of half its turn's number,
    and at each third turn that of the exchange before. A few calls name no
    known tool, have arguments outside their schema, or broken JSON."""
    c = F.col
    ident = lambda turn: F.substring(F.md5(F.concat_ws(":", c("conv_id"), turn)), 1, 12)
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    tool = F.when(n % 23 == 0, "translate").when(n % 2 == 0, "search").otherwise("classify")
    search = F.to_json(F.struct(c("text").alias("query"), n.alias("limit")))
    label = F.to_json(F.struct((n % 11 / 10).alias("threshold"), c("text"), F.array(F.lit("a"), c("role")).alias("labels")))
    arguments = F.when(n % 19 == 0, F.expr("left(arguments, length(arguments) - 1)")).otherwise(c("arguments"))
    half = 2 * F.floor((c("turn") + 1) / 4).cast("long") - 1
    turns = conversations.select("conv_id", "turn", "role", "text")
    calls = (turns.where("role = 'assistant'")
             .withColumn("arguments", F.when(tool == "search", search).otherwise(label))
             .select("conv_id", ident(c("turn")).alias("call_id"), c("turn").alias("seq"), tool.alias("tool"), arguments.alias("arguments"),
                     F.when(c("turn") >= 3, F.array_compact(F.array(ident(half), F.when(c("turn") % 3 == 0, ident(c("turn") - 2)))))
                     .otherwise(F.array().cast("array<string>")).alias("needs")))
    results = turns.where("role <> 'assistant' or role is null").select(
        "conv_id", ident(c("turn") - 1).alias("call_id"), c("turn").alias("seq"), c("text").alias("content"))
    return calls, results


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked, ordered and checked messages of every conversation."""
    calls, results = tool_turns(table(spark, sf_dir, "conversations"))
    return tool_calls.link_tool_calls(calls, results, SCHEMAS)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    g = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
                    F.col("component").alias("component_id"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the rule cascade for every document."""
    return quality.quality(table(spark, sf_dir, "documents"))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log probability of every document; rows with remainder 1
    are held out. A training row's language is its class."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (~held).alias("train"))
    r = lattice_lm.lm_score(d, "train", kind="lang")
    return r.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside fold 0."""
    r = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return r.select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"), "score", "predicted")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on more than 2 % of a source's documents, taken out of them."""
    d = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return d.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    d = mixing.mix_counts(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return d.select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts. The digest column wants the hash of every text,
    also of those whose content the operator itself never hashes."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.unhex(F.sha2(exact_dedup.normalised("text"), 256)).alias("sha"))
    r = exact_dedup.exact_dedup(d, carry=("sha",))
    return r.select("doc_id", F.col("keep_key").alias("keep_id"), "group_size", "kept",
                    F.lower(F.hex("sha")).alias("text_sha256"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    r = licenses.license_scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct("places.label"))
    return r.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").alias("first_word"), F.array_max("places.at").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "template_labels")), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.col("containment")).alias("score"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return sentencepiece_fst.encode(table(spark, sf_dir, "documents"))


def repeated_from(doc_id: str, text: str) -> Column:
    """The text, in one of ten documents with its words from a place on
    repeated at a period; place and period follow from crc32 of the id."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words).cast("long")
    a = g % F.nullif(n, F.lit(0))
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    planted = F.transform(
        F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p"))),
        lambda x: F.array_join(F.transform(x.w, lambda w, i: F.when(i < x.a, w).otherwise(
            F.get(x.w, (x.a + (i - x.a) % x.p).cast("int")))), " "))
    return F.when((h % 10 == 0) & (F.col(text).rlike(r"[^\x20\x09-\x0D]")), F.get(planted, F.lit(0))).otherwise(F.col(text))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, longest run and digests of runs and collapsed text of
    every document, some of which get a run planted."""
    d = table(spark, sf_dir, "documents").select("doc_id", repeated_from("doc_id", "text").alias("text"))
    r = periodic_runs.periodic_runs(d).withColumn("best", F.get(F.array_sort(F.transform("runs", lambda x: F.struct(
        (-x.length).alias("l"), x.start.alias("start"), x.period.alias("period")))), F.lit(0)))
    line = lambda x: F.concat_ws(",", x.start, x.length, x.period)
    listed = F.array_join(F.transform("runs", lambda x: F.concat(line(x), F.lit("\n"))), "")
    return r.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.period").alias("period"),
        F.floor(F.expr("1000 * -best.l") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows with remainder 2 are held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    d = table(spark, sf_dir, "documents")
    r = language_id.identify(d, language_id.fit(d.where(~held)), carry=("doc_id",))
    return r.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {f.__name__: f for f in (
    op1_tool_calls, op2_simhash, op3_quality, op4_lattice_lm, op5_toxicity, op6_line_dedup,
    op7_mixing, op8_exact_dedup, op9_licenses,
    op10_sentencepiece, op11_periodic_runs, op12_lexical_search, op13_language_id)}
