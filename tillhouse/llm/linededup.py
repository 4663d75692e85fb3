"""Line deduplication by a log-template tree, in DataFrame operations only.

A document's lines (split at newlines, trimmed, not blank) are parsed into a
tree of fixed depth: the number of space-separated tokens, then the leading
LEAD tokens.  A token that holds a digit is a variable field, ``<*>``.  Lines
that end at the same leaf are a node; nodes are searched for templates in rounds:

* a node's template keeps, at each position, the token that more than half
  of the node's (document, line) pairs have there, and ``<*>`` elsewhere; a
  line belongs to it if at least SIMILARITY of its positions agree, and of
  those that are no fields as well, and at least CONSTANT of its positions
  are words that agree: lines of numbers have no template;
* where these lines are in MIN_DOCS documents, they leave, and the node's
  other lines vote once more; else, or the second time, the node is split:
  each line follows its most voted token among those that at most half of the
  pairs have, which is one more level of the tree and at least halves the node;
* a line ends its search when fewer than SIMILARITY of its positions have
  tokens that could still be a majority of MIN_DOCS pairs.  A node at least
  halves in two rounds, so there are at most 2 log2(pairs of the largest leaf).

A node's template found in at least MIN_DOCS documents is recurring, and so is
a line that stands word for word, digit for digit, in at least EXACT_DOCS;
recurring lines are dropped from all these documents but the one with the
smallest id, so that a group of copies keeps one whole text.  Within a
document, nothing is dropped for repeating itself.  A line is known by two
64-bit hashes of its text.

Skew: (line, document) pairs are made distinct first, which spreads a hot line
over all tasks; counts then have partial sums; a node's token votes are sums
over (node, position, token).  No line's or leaf's rows are collected.

Texts are dealt out once, into buckets by row; the lines that vote and the
final joins move only positions.

Edge cases: null and empty texts have no lines and stay as they are; documents
without id are one document; rows that repeat an id count once and lose the
same lines; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import bucketed, discard, stage

LEAD = 3
MIN_DOCS = 3
EXACT_DOCS = 2
SIMILARITY = 0.8
CONSTANT = 0.5
FIELD = "<*>"


def _masked(line: Column) -> Column:
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ 0-9]*[0-9][^ ]*", FIELD)).otherwise(line)


def _split(text_col: str) -> Column:
    return F.split(F.col(text_col).cast("string"), "\n")


def _occurrences(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (uid, doc_id, pos, line_id, leaf) of lines that are not blank; pos counts all lines from 0."""
    lines = rows.select(F.col("__uid").alias("uid"), F.col(id_col).alias("doc_id"), F.posexplode(_split(text_col)).alias("pos", "line"))
    lines = lines.select("uid", "doc_id", "pos", F.trim("line").alias("line")).where("line <> ''")
    masked = _masked(F.col("line"))
    n = F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1
    return lines.select("uid", "doc_id", "pos",
                        F.struct(F.xxhash64(F.lit("line"), "line").alias("a"), F.xxhash64(F.lit("text"), "line").alias("b")).alias("line_id"),
                        F.xxhash64(F.lit("leaf"), n, F.substring_index(masked, " ", LEAD)).alias("leaf"))


def _search(spark: SparkSession, occurs: DataFrame, lines: DataFrame, min_docs: int, similarity: float) -> list[DataFrame]:
    """From rows (line_id, node, again, votes, n_docs, tokens): the members of all templates, a table for each round.

    ``again`` marks a node whose last template has left; it is split next.
    """
    found: list[DataFrame] = []
    while True:
        fields = F.size(F.filter("tokens", lambda t: t == FIELD))
        tokens = lines.select("line_id", "node", "again", "votes", "n_docs", F.size("tokens").alias("n"), fields.alias("n_fields"), "tokens")
        # Counted before the tokens are dealt out: beside the generator they would be counted for every token.
        tokens = tokens.select("line_id", "node", "again", "votes", "n_docs", "n", "n_fields", F.posexplode("tokens").alias("at", "token"))
        tokens = tokens.withColumn("pair", F.xxhash64("node", "at", "token")).withColumn("word", F.col("token") != FIELD).drop("token")
        # Written before the join, so that a hot pair can be split there.
        have = tokens.groupBy("pair").agg(F.sum("n_docs").alias("have")).where(F.col("have") * 2 > min_docs)
        have = stage(spark, have, "token-votes")
        constant = F.col("have") * 2 > F.col("votes")
        seen = tokens.join(have, "pair").groupBy("line_id", "node", "again", "n_docs", "n", "n_fields").agg(
            F.count("*").alias("able"), F.count(F.when(constant, 1)).alias("same"), F.count(F.when(constant & F.col("word"), 1)).alias("words"),
            F.max(F.when(~constant & (F.col("have") >= min_docs), F.struct("have", -F.col("at"), "pair"))).alias("best"))
        enough = F.lit(similarity) * F.col("n")
        member = ((F.col("same") >= enough) & (F.col("words") >= F.lit(similarity) * (F.col("n") - F.col("n_fields")))
                  & (F.col("words") >= F.lit(CONSTANT) * F.col("n")))
        seen = stage(spark, seen.where(F.col("able") >= enough).select(
            "line_id", "node", "again", "n_docs", member.alias("member"), F.col("best.pair").alias("pair")), "node-lines")

        member = seen.where("member").select("line_id", "node")
        group = occurs.join(member, "line_id").select("node", "doc_id").distinct()
        group = (group.groupBy("node").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
                 .where(F.col("n_docs") >= min_docs))
        group = stage(spark, group, "templates")
        found.append(stage(spark, member.join(group, "node").select(
            "line_id", F.col("node").alias("template"), "n_docs", "first_doc"), "template-lines"))

        rest = seen.join(group.select("node", F.lit(True).alias("left")), "node", "left").where("left is null or not member")
        once = F.coalesce(F.col("left") & ~F.col("again"), F.lit(False))
        rest = rest.where(once | F.col("pair").isNotNull()).select(
            "line_id", "n_docs", once.alias("again"), F.when(once, F.xxhash64(F.lit("rest"), "node")).otherwise(F.col("pair")).alias("node"))
        rest = stage(spark, rest, "open-lines")
        nodes = rest.groupBy("node").agg(F.count("*").alias("n_lines"), F.sum("n_docs").alias("votes"))
        nodes = stage(spark, nodes.where((F.col("n_lines") > 1) & (F.col("votes") >= min_docs)).select("node", "votes"), "open-nodes")
        if nodes.isEmpty():
            return found
        rest = rest.join(nodes, "node").select("line_id", "node", "again", "votes", "n_docs")
        done, lines = lines, stage(spark, rest.join(lines.select("line_id", "tokens"), "line_id"), "open-tokens")
        if len(found) == 1:
            occurs = stage(spark, occurs.join(lines.select("line_id"), "line_id").select("line_id", "doc_id").distinct(), "open-pairs")
        for old in (done, have, seen):
            discard(spark, old)


def recurring_lines(spark: SparkSession, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_docs: int = MIN_DOCS, similarity: float = SIMILARITY,
                    exact_docs: int = EXACT_DOCS) -> tuple[DataFrame, DataFrame]:
    """From rows with __uid: (occurrences, recurring line_ids with template, n_docs and first_doc)."""
    occurs = stage(spark, _occurrences(rows, id_col, text_col), "lines")
    pairs = occurs.groupBy("line_id", "leaf", "doc_id").agg(F.min(F.struct("uid", "pos")).alias("at"))
    lines = stage(spark, pairs.groupBy("line_id", "leaf").agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"), F.min("at").alias("at")), "line-counts")

    # Leaves with several lines vote on each position; a line is read where it stands first.
    shared = lines.groupBy("leaf").agg(F.count("*").alias("n_lines"), F.sum("n_docs").alias("votes"))
    # Written before the join, so that a hot leaf can be split there; so is what each position has.
    shared = stage(spark, shared.where((F.col("n_lines") > 1) & (F.col("votes") >= min_docs)).select("leaf", "votes"), "shared-leaves")
    voters = lines.join(shared, "leaf").select("at.uid", "at.pos", "line_id", "leaf", "votes", "n_docs")
    voters = voters.groupBy("uid").agg(F.collect_list(F.struct("pos", "line_id", "leaf", "votes", "n_docs")).alias("v"))
    read = rows.select(F.col("__uid").alias("uid"), _split(text_col).alias("lines")).join(voters, "uid")
    read = read.select("lines", F.explode("v").alias("v")).select(
        "v.line_id", F.col("v.leaf").alias("node"), F.lit(False).alias("again"), "v.votes", "v.n_docs",
        F.split(_masked(F.trim(F.element_at("lines", F.col("v.pos") + 1))), " ").alias("tokens"))
    read = stage(spark, read, "leaf-lines")

    grouped = reduce(DataFrame.unionByName, _search(spark, occurs, read, min_docs, similarity))
    alone = (lines.where(F.col("n_docs") >= exact_docs).join(grouped.select("line_id"), "line_id", "left_anti")
             .select("line_id", F.col("line_id.a").alias("template"), "n_docs", "first_doc"))
    recurring = stage(spark, grouped.unionByName(alone), "recurring-lines")
    return occurs, recurring


def dedup_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options: float) -> DataFrame:
    """The rows of ``docs`` with __kept (the text without dropped lines), __n_lines and __n_dropped."""
    rows = bucketed(spark, docs.withColumn("__uid", F.monotonically_increasing_id()), "lined_texts", "__uid")
    occurs, recurring = recurring_lines(spark, rows, id_col, text_col, **options)
    hit = occurs.join(recurring, "line_id").where(F.coalesce(F.col("doc_id") != F.col("first_doc"), F.col("first_doc").isNotNull()))
    drops = stage(spark, hit.groupBy(F.col("uid").alias("__uid")).agg(F.collect_list("pos").alias("__drops")), "line-drops")
    done = rows.join(drops, "__uid", "left").drop("__uid")
    kept = F.array_join(F.filter(_split(text_col), lambda line, i: ~F.array_contains("__drops", i)), "\n")
    return done.withColumns({
        "__kept": F.when(F.col("__drops").isNull(), F.col(text_col).cast("string")).otherwise(kept),
        "__n_lines": F.coalesce(F.size(F.filter(_split(text_col), lambda line: F.trim(line) != "")), F.lit(0)).cast("long"),
        "__n_dropped": F.coalesce(F.size("__drops"), F.lit(0)).cast("long"),
    }).drop("__drops")


def remove_recurring(spark: SparkSession, docs: DataFrame, text_col: str = "text", **options: object) -> DataFrame:
    """``docs`` without recurring lines; a document that had text and has none left goes."""
    rows = dedup_lines(spark, docs, text_col=text_col, **options)
    empty = (F.col("__n_dropped") > 0) & (F.trim(F.regexp_replace("__kept", "\\s+", " ")) == "")
    size: dict[str, Column] = {"n_chars": F.when(F.col("__n_dropped") > 0, F.length("__kept").cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return (rows.where(~empty | F.col("__kept").isNull()).withColumns({text_col: F.col("__kept"), **size})
            .select([F.col(f"`{c}`") for c in docs.columns]))
