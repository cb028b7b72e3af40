"""Line deduplication by a fixed-depth template tree.

Each line with a word is cut into tokens; tokens with a digit, an @ or :// become the wildcard.  The tree has a
level for the token count and one for each of the leading tokens; a leaf holds the lines that agree in all
of these.  A token's support is the number of the leaf's distinct lines that have it at that position.  A line needs
half of its tokens, and one beyond the leading ones, with a support of two or more; the weakest of the best-supported ones
it needs bounds how many lines are like it.  Its tokens with at least MIN_SHARE of that support stay constant, the others
become the wildcard, so other lines of a leaf do not change a template, however many.  A template that less than
MIN_SHARE of that many lines have is a chance meeting of common tokens; its lines, and those without enough constants,
are templates of their own.  Nothing depends on an arrival order.

A template that occurs in min_docs documents or more is recurring: its lines are dropped from every document but
the one with the smallest doc_id.  Lines without a word are kept, and so are the lines of rows with a null doc_id,
which count for no template.  Null texts give one empty line.  Rows with equal doc_id count as one document.

Every count is combined before it is shuffled; a line that a third of the documents share is one row of each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 3
MIN_DOCS = 10
MIN_SHARE = 0.1      # of the similar lines that have a constant token
MIN_CONSTANT = 0.5   # of a template's tokens
WILDCARD = "<*>"


def spaced(line: Column) -> Column:
    """A line's words with one space between them."""
    odd = line.rlike(r"[\x09-\x0D]") | line.contains("  ")
    return F.trim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))


def masked(words: Column) -> Column:
    """Spaced words, variable ones as the wildcard; each word is looked through once, from its start."""
    found = F.regexp_replace(words, r"(?<![^\x20])[^\x20]*?(?:[0-9@]|://)[^\x20]*+", WILDCARD)
    return F.when(words.rlike("[0-9@:]"), found).otherwise(words)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, the text's hash (rows with equal doc_id are told apart by it) and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    lines = (docs.where("doc_id is not null").select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
             .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
             .select("doc_id", "text_key", "line_no", spaced(F.col("line")).alias("words")))
    # most lines are alone in their leaf: only the leading words are masked here, without a lambda for each word
    n_tokens = F.octet_length("words") - F.octet_length(F.replace("words", F.lit(" "), F.lit("")))
    return lines.select("doc_id", "text_key", "line_no", "words", F.xxhash64(n_tokens, masked(F.substring_index("words", " ", depth))).alias("leaf"))


def templates(lines: DataFrame, depth: int = DEPTH, min_share: float = MIN_SHARE, min_constant: float = MIN_CONSTANT) -> DataFrame:
    """leaf, line key and template key of each distinct line of the given leaves."""
    distinct = lines.groupBy("leaf", "line_key").agg(F.first("masked").alias("masked"))
    size = distinct.groupBy("leaf").agg(F.count("*").alias("n_lines"))
    many = size.where("n_lines > 1")
    at = (distinct.join(many, "leaf").select("leaf", "line_key", F.posexplode(F.split("masked", " ")).alias("pos", "token")))
    support = at.groupBy("leaf", "pos", "token").agg(F.count("*").alias("support"))
    part = (at.join(support, ["leaf", "pos", "token"])
            .select("leaf", "line_key", F.struct("pos", "token", F.when((F.col("support") >= 2) & (F.col("token") != WILDCARD), F.col("support")).alias("support")).alias("part")))
    shaped = part.groupBy("leaf", "line_key").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    leading = F.size(F.filter("parts", lambda x: (x["pos"] < depth) & x["support"].isNotNull()))
    beyond = F.sort_array(F.transform(F.filter("parts", lambda x: (x["pos"] >= depth) & x["support"].isNotNull()), lambda x: x["support"]), asc=False)
    needed = F.greatest(F.lit(1), F.ceil(F.size("parts") * F.lit(min_constant)).cast("int") - leading)
    # support of the weakest token that the line needs: no more lines than these agree with it in enough tokens
    shaped = shaped.withColumn("alike", F.get(beyond, needed - 1)).where("alike is not null")
    stays = lambda x: (x["pos"] < depth) | (x["support"] >= F.col("alike") * F.lit(min_share))
    shape = F.transform("parts", lambda x: F.when(x["support"].isNotNull() & stays(x), x["token"]).otherwise(WILDCARD))
    found = shaped.select("leaf", "line_key", "alike", F.xxhash64(F.lit("general"), shape).alias("general")).checkpoint()
    chance = (found.groupBy("leaf", "general", "alike").agg(F.count("*").alias("n")).where(F.col("n") < F.col("alike") * F.lit(min_share)).select("leaf", "general"))
    found = found.join(chance, ["leaf", "general"], "left_anti").select("leaf", "line_key", "general")
    return (distinct.select("leaf", "line_key").join(found, ["leaf", "line_key"], "left")
            .select("leaf", "line_key", F.coalesce("general", F.xxhash64(F.lit("own"), "line_key")).alias("template")))


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE, min_constant: float = MIN_CONSTANT) -> DataFrame:
    """doc_id, text_key and the numbers (from 0) of the lines to drop, for the documents that have some."""
    lines = _lines(_keyed(docs), depth)
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    # lines that share a leaf with enough others, masked as a whole; the leaves of most prose lines hold one line
    lines = (lines.join(leaves, "leaf").select("doc_id", "text_key", "line_no", "leaf", masked(F.col("words")).alias("masked"))
             .withColumn("line_key", F.xxhash64("masked")).checkpoint())
    lines = lines.join(templates(lines, depth, min_share, min_constant), ["leaf", "line_key"]).select("doc_id", "text_key", "line_no", "leaf", "template")
    recurring = (lines.select("leaf", "template", "doc_id").distinct().groupBy("leaf", "template")
                 .agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")).where(F.col("n_docs") >= min_docs))
    return (lines.join(recurring, ["leaf", "template"]).where("doc_id <> first_doc")
            .groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("dropped")))


def drop_lines(docs: DataFrame, **rules) -> DataFrame:
    """row (all columns of docs), doc_id, kept_text, n_lines and n_dropped of every row of docs."""
    dropped = recurring_lines(docs, **rules)
    kept = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"))
    kept = kept.withColumn("text_key", F.xxhash64("text")).join(dropped, ["doc_id", "text_key"], "left")
    every = F.split("text", "\n")
    gone = F.coalesce("dropped", F.array().cast("array<int>"))
    return kept.select("row", "doc_id", F.when(F.col("dropped").isNull(), F.col("text"))
                       .otherwise(F.array_join(F.filter(every, lambda x, i: ~F.array_contains(gone, i)), "\n")).alias("kept_text"),
                       F.size(every).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"))


def without_recurring_lines(docs: DataFrame, **rules) -> DataFrame:
    """docs with the kept text (and its length in n_chars, where there is one); rows that had words and have none left go."""
    kept = drop_lines(docs, **rules).where(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]") | (F.col("n_dropped") == 0))
    return with_text(kept, docs, F.when(F.col("n_dropped") == 0, F.col("row.text")).otherwise(F.col("kept_text")))


def with_text(kept: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of docs out of ``row``, with a new text and its length in n_chars."""
    new = {"text": text, "n_chars": F.length(text)}
    return kept.select(*((new[f.name] if f.name in new else F.col("row").getField(f.name)).cast(f.dataType).alias(f.name) for f in docs.schema))
