"""From raw documents to token ids: five stages, each one operator of ``contactgate.llm``.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and
returns the next stage's ``docs``.  All but the last return the columns of
``documents``.  ``run`` applies them to the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactgate.llm import bpe, language, mixing, simhash, suffix
from contactgate.llm.common import is_empty, materialized, table, union
from contactgate.llm.queries import vocabulary

MIN_POSTERIOR = 0.5
BATCH = 1024            # copies of equal rows made at a time


def _row(docs: DataFrame) -> Column:
    """All columns as one struct, out of reach of other names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _name(docs: DataFrame) -> Column:
    """A hash of all columns: rows equal in every column share it, others do not."""
    return F.concat(F.md5(F.coalesce("text", F.lit(""))), F.hex(F.xxhash64(*[
        x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised: they have letters and the
    best language has at least half of the posterior.  The model learns from
    the documents that carry a language."""
    model = language.fit(docs)
    lang, posterior = _unused(docs, "language_found"), _unused(docs, "posterior_found")
    marked = language.identify(docs, model, "text", lang, posterior)
    return (marked.where((F.col(lang) != language.UNKNOWN) & (F.col(posterior) >= MIN_POSTERIOR))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id.

    Null ids come last, so they name a group only if it has no other id.  Of rows
    that share the id within the group the one with the smallest text stays (a null
    text before all others, then by the other columns).  Groups are told apart by
    their fingerprints, never by an id, which several groups may share.

    Texts are fingerprinted once; which rows stay is decided on ids, fingerprints and row
    names alone, and the texts are joined to the names last."""
    marked = materialized(simhash.fingerprints(docs.select("doc_id", "text", _name(docs).alias("name")))
                          .select("doc_id", "fp", "name"))
    m, g = marked.alias("m"), simhash.groups(marked.select("doc_id", "fp")).alias("g")
    named = materialized(
        m.join(g, (F.col("m.fp") == F.col("g.fp")) & F.col("m.doc_id").eqNullSafe(F.col("g.component_id")))
        .groupBy("g.component", "m.name").agg(F.count(F.lit(1)).alias("rows")))
    first = named.groupBy("component").agg(F.min("name").alias("name"), F.sum("rows").alias("rows"))
    d = docs.select(_name(docs).alias("name"), _row(docs))
    once = d.join(first.where("rows = 1").select("name"), "name", "left_semi").select("row.*")
    tied = first.where("rows > 1").select("component")
    if is_empty(tied):
        return once
    by = ["text", *[c for c in docs.columns if c != "text"]]
    again = (d.join(named.join(tied, "component").select("component", "name"), "name")
             .groupBy("component").agg(F.min(F.struct(*[F.col(f"row.`{c}`") for c in by])).alias("row")))
    return union(once, again.select(*[F.col(f"row.`{c}`") for c in docs.columns]))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of 100 bytes or more that also start earlier; ``n_chars`` is
    counted again.  Every document stays, if only as an empty text; null texts
    stay null."""
    found = suffix.remove_repeats(
        docs.select("doc_id", "text", F.struct(F.col("text").isNull().alias("null"), *[
            F.col(f"`{c}`").alias(f"of {c}") for c in docs.columns if c not in ("doc_id", "text")]).alias("rest")),
        carry=("rest",), whole_characters=True)
    known = ~F.col("carried.rest.null")
    made = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType),
            "text": F.when(known, F.col("kept")), "n_chars": F.when(known, F.length("kept").cast("long"))}
    return found.select(*[made.get(c, F.col(f"carried.rest.`of {c}`")).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 rows).

    Rows are named by a hash of all their columns, so rows that share an id, or have
    none, are each taken as the mix decided.  Rows equal in every column are
    interchangeable and taken together as often as the mix takes them in all."""
    name = _name(docs)
    decided = materialized(
        mixing.mix(docs.select("doc_id", "source", "text", name.alias("name")), carry=("name",))
        .groupBy("carried.name").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0"))
    d = docs.select(name.alias("name"), _row(docs))
    once = (d.join(decided.where("rows = 1"), "name")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
    if is_empty(decided.where("rows > 1")):
        return once
    # one of equal rows, repeated in two steps: no array is longer than copies / BATCH or BATCH
    again = (d.join(decided.where("rows > 1"), "name").groupBy("name")
             .agg(F.min("row").alias("row"), F.max("copies").alias("copies"))
             .select("row", "copies", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(BATCH))).alias("at"))
             .select("row", F.explode(F.sequence(F.lit(1), F.least(F.lit(BATCH), F.col("copies") - F.col("at")))))
             .select("row.*"))
    return union(once, again)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, read back once to make sure of them: ``doc_id, lang,
    source, ids, n_tokens, reads_back``.  A null text has no ids, like an empty one.  The
    text itself, ``n_chars`` and any other column end here."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary(),
                       checked_out="reads_back", without=("text",))
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "reads_back")


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("mixing to target weights", mixed),
    ("byte-level BPE", encoded),
]

#: SQL can express neither the classifier nor the encoder; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
