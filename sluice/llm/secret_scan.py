"""Secret scans: a random forest that removes false positives.

Candidates are runs of 16 or more letters, digits and ``+ / _ -`` that hold a digit, with the words around
them.  The forest looks at the candidate's length, how its characters change from class to class,
how much of it the corpus's own words cover, its path, and the neighbouring words.
It is trained on labelled findings, a bounded number of each label.

Only DataFrame functions and Spark's own forest are used.

Defined results: null and empty texts have no candidates; null paths are empty; null labels
are not used; when one label is missing nothing is removed and the probability is null;
repeated rows give their findings each; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged

#: Starting only where no such character stands before keeps the search linear.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
BLANKS = r"[ \t-\r]+"
#: Names that secrets are given.
NAMES = "token|secret|passw|pwd|key|auth|credential|bearer|private|signature"
#: Labelled findings the forest is trained on, for each label, at most.
TRAINING_ROWS = 10_000
#: Letters a word of the corpus must have, and documents that must hold it, to count as a word.
LEAST_LETTERS = 3
LEAST_DOCUMENTS = 5
#: Different pieces of candidates up to which they are broadcast, at some 60 bytes each.
BROADCAST_PIECES = 1_000_000
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """doc_id, path, word_index, nth, candidate, word, before (three words), after (one word)."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
        F.col(text_col).alias("text"),
    )
    some = narrow.filter(F.col("text").rlike(CANDIDATE)).withColumn("words", F.split("text", BLANKS))
    words = F.col("words")
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).rlike(CANDIDATE))
    at = F.col("word_index")
    each = some.select("doc_id", "path", "words", F.explode(places).alias("word_index")).select(
        "doc_id",
        "path",
        "word_index",
        F.get(words, at).alias("word"),
        F.array(*(F.lower(F.coalesce(F.get(words, at - k), F.lit(""))) for k in (3, 2, 1))).alias("before"),
        F.lower(F.coalesce(F.get(words, at + 1), F.lit(""))).alias("after"),
    )
    found = F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))
    return each.select("*", F.posexplode(found).alias("nth", "candidate"))


def _pieces(found: DataFrame) -> DataFrame:
    """The different runs of letters in candidates, in lower case."""
    letters = F.regexp_extract_all(F.lower("candidate"), F.lit(f"[a-z]{{{LEAST_LETTERS},}}"), F.lit(0))
    return found.select("candidate", F.explode(letters).alias("piece"))


def coverage(spark: SparkSession, found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """candidate and covered: its share of characters in pieces that are words of many documents.

    Every word of every document is compared with the pieces; words in documents are counted once each.
    """
    pieces = staged(spark, _pieces(found).distinct(), "pieces")
    wanted = staged(spark, pieces.select(F.col("piece").alias("word")).distinct(), "wanted")
    words = F.array_distinct(F.split(F.lower(text_col), "[^a-z]+"))
    said = docs.select(F.explode(words).alias("word"))
    if wanted.count() <= BROADCAST_PIECES:
        said = said.join(F.broadcast(wanted), "word", "left_semi")
        known = said.groupBy("word").count()
    else:
        known = said.groupBy("word").count().join(wanted, "word", "left_semi")
    known = known.filter(F.col("count") >= LEAST_DOCUMENTS).select(F.col("word").alias("piece"))
    shares = pieces.join(known, "piece").groupBy("candidate").agg(F.sum(F.length("piece")).alias("letters"))
    # A piece that occurs twice in a candidate counts once, so the share is at most one.
    return shares.select(F.col("candidate").alias("covered_candidate"), (F.col("letters") / F.length("candidate")).alias("covered"))


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def features(found: DataFrame, covered: DataFrame) -> DataFrame:
    """``found`` with a number in each column that is named in FEATURES."""
    joined = found.join(covered, F.col("candidate") == F.col("covered_candidate"), "left").drop("covered_candidate")
    near = F.concat_ws(" ", "before", F.lower("word"))
    number = {
        "length": F.least(F.length("candidate"), F.lit(1000)),
        "turns": _share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[+/_-])[^+/_-]"),
        "letter_digit": _share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "vowel_consonant": _share("(?<=[aeiouAEIOU])[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]"),
        "digits": _share("[0-9]"),
        "hexadecimal": _share("[0-9a-f]"),
        "capitals": _share("[A-Z]"),
        "symbols": _share("[+/_-]"),
        "variety": F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate"),
        "covered": F.coalesce("covered", F.lit(0.0)),
        "path_depth": F.regexp_count("path", F.lit("/")),
        "path_test": F.lower("path").rlike("test|example|sample|mock|fixture|doc"),
        "path_code": F.lower("path").rlike(r"\.(py|js|ts|java|go|rb|sh|env|ya?ml|json|toml|ini|cfg|properties)$"),
        "named": near.rlike(NAMES),
        "assigned": near.rlike("[=:]"),
        "quoted": F.col("word").rlike("[\"'`]"),
        "before_number": F.element_at("before", -1).rlike("^[0-9().+-]+$"),
        "before_words": F.size(F.filter("before", lambda w: w.rlike(r"^[\p{L}]+[.,;]?$"))),
        "after_word": F.col("after").rlike(r"^[\p{L}]+[.,;]?$"),
    }
    return joined.withColumns({f"f_{name}": column.cast("double") for name, column in number.items()})


FEATURES = [
    "length", "turns", "letter_digit", "vowel_consonant", "digits", "hexadecimal", "capitals", "symbols", "variety",
    "covered", "path_depth", "path_test", "path_code", "named", "assigned", "quoted", "before_number",
    "before_words", "after_word",
]


def train(spark: SparkSession, labelled: DataFrame, rows: int = TRAINING_ROWS):
    """A forest from featured findings with a ``label`` of 0 or 1; None when one label is missing."""
    columns = [F.coalesce(f"f_{name}", F.lit(0.0)).alias(f"f_{name}") for name in FEATURES]
    order = F.xxhash64("candidate", "doc_id", "word_index", "nth")
    used = labelled.select(*columns, F.col("label").cast("double").alias("label"), order.alias("order"))
    parts = [used.filter(F.col("label") == label).orderBy("order", *FEATURE_COLUMNS).limit(rows) for label in (0.0, 1.0)]
    sample = staged(spark, parts[0].unionAll(parts[1]), "labelled")
    if sample.select("label").distinct().count() < 2:
        return None
    # One partition in a fixed order, so that the same rows give the same forest.
    sample = sample.coalesce(1).sortWithinPartitions("label", "order", *FEATURE_COLUMNS)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8
    )
    return forest.fit(_assembled(sample))


FEATURE_COLUMNS = [f"f_{name}" for name in FEATURES]


def _assembled(featured: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features").transform(featured)


def judge(model, featured: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, word_index, nth, candidate, probability that it is a secret, and kept."""
    if model is None:
        judged = featured.withColumn("chance", F.lit(None).cast("double"))
    else:
        judged = model.transform(_assembled(featured)).withColumn("chance", vector_to_array("probability")[1])
    return judged.select(
        "doc_id",
        "path",
        F.col("word_index").cast("long").alias("word_index"),
        F.col("nth").cast("long").alias("nth"),
        "candidate",
        F.round("chance", 6).alias("probability"),
        F.coalesce(F.col("chance") >= threshold, F.lit(True)).alias("kept"),
    )


def scan(
    spark: SparkSession,
    docs: DataFrame,
    label: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    rows: int = TRAINING_ROWS,
) -> DataFrame:
    """All findings in ``docs`` and which are kept; ``label`` gives 0, 1 or null from a finding's columns."""
    prepare(spark)
    found = staged(spark, findings(docs, id_col, text_col, path_col), "findings")
    covered = staged(spark, coverage(spark, found, docs, text_col), "covered")
    featured = staged(spark, features(found, covered), "featured")
    return judge(train(spark, featured.withColumn("label", label), rows), featured)
