"""Secret scan: a random forest removes false positives.

Candidates are all character runs of at least ``min_length`` that could hold a
credential, and of a run with inner = or : also every piece of that length.
What is assigned to a credential name, and the password of
scheme://user:password@host, is a candidate whatever its symbols, from
``short_length`` characters. Each gets features of its length, its character transitions, how
much of it a dictionary covers, the path (the source) and the neighbouring
words. A random forest learned from labelled findings scores every candidate;
those under the threshold are false positives.

``weak_labels`` makes labelled findings where none are at hand: a well-known
credential format, or an assignment to a credential name of something that
isn't prose, or an address's password, is a secret; prose, addresses and checksums without one are not;
the rest stays unlabelled. Learning uses at most ``max_rows`` findings of each
label. Everything is DataFrame functions and the JVM's random forest; there is
no Python on the executors.

Edge cases: NULL and empty texts have no candidates; a NULL source is an empty
path; repeated rows and values are separate findings; with labelled findings
of fewer than two kinds every candidate scores as its weak label says; no
documents give no findings; documents with a NULL id are scanned and masked
like others, also where several share it. Further columns of the documents are ignored, or
pass through ``redact``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stage

#: labelled findings of each label to learn from, at most
MAX_ROWS = 10_000
MIN_LENGTH = 16
#: the least length of a value assigned to a credential name, or of an address's password
SHORT_LENGTH = 4
#: Frequent words and word parts of English, French, German and Spanish, and of placeholders.
DICTIONARY = (
    "the and ing tion ent her for tha nth int ere ver all are ation ble oun ould ess hea she "
    "eau que ment elle oir eux aux pour leur ette our ais tre "
    "lich heit keit ung sch ein der die und nicht ver ber ach "
    "cion mente ado ada que los las rra osa ita ez "
    "example sample dummy test placeholder changeme your here user name file path data http www com org net"
).split()
_CREDENTIAL = r"(?i)(token|secret|passw|pwd|credential|api[_.-]?key|apikey|access[_.-]?key|private[_.-]?key|auth|bearer)"
_CHECKSUM = r"(?i)(sha\d*|md5|checksum|digest|commit|hash|uuid|guid|etag|integrity)"
_FORMAT = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk[-_](live_|test_)?[A-Za-z0-9]{20,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_.-]{10,}|AIza[A-Za-z0-9_-]{30,})$"
_PATH = r"(?i)(test|spec|example|sample|mock|fixture|doc|readme)"
_ASSIGN = r"""(=|:)["'` ]*$"""
#: What is assigned to a credential name, whatever its symbols and length, and the password in scheme://user:password@host;
#: both are put between marks, which no value holds.
_MARKS = "\x01\x02"
_NAMED = (r"""(?i)((?:token|secret|passw|passphrase|pwd|credential|api[_.-]?key|access[_.-]?key|private[_.-]?key"""
          r"""|auth(?!or(?!iz))|bearer)[A-Za-z0-9_.\]-]{0,24}(?:\\?["'`])?[ \t]{0,8}(?:=>|:=|={1,3}|:)[ \t]{0,8}(?:\\?["'`])?)"""
          r"""((?<=["'`])[^\s"'`\x01\x02]{LEAST,}+|[^\s"'`\x01\x02]{LEAST,}(?<![,;.)\]}>:]))""")
_USERINFO = r"""(://[^\s/:@"'`\x01\x02]*+:)([^\s"'`/\x01\x02]{LEAST,})(?=@[A-Za-z0-9\[])"""
_TOKEN = r"\x01[^\x02]*+\x02|[A-Za-z0-9+/_=:.@-]+"
#: between a piece with the separators after it and the next piece
_PIECES = r"(?<=[^A-Za-z0-9+/_.@-])(?=[A-Za-z0-9+/_.@-])"

FEATURES = ["len", "digits", "uppers", "symbols", "hex", "distinct", "turns", "vowel_turns", "longest_letters",
            "dictionary", "test_path", "credential", "checksum", "assigned", "address", "after_words", "userinfo", "mixed"]


def candidates(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text",
               path_col: str = "source", short_length: int = SHORT_LENGTH) -> DataFrame:
    """(doc_id, token, value, before, after, path): one row per candidate;
    ``token`` counts the text's tokens before it."""
    path = F.col(path_col).cast("string") if path_col in docs.columns else F.lit(None).cast("string")
    text = F.translate(F.col(text_col), _MARKS, " " * len(_MARKS))
    for place in (_USERINFO, _NAMED):
        text = F.regexp_replace(text, place.replace("LEAST", str(short_length)), "$1\x01$2\x02")
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(path, F.lit("")).alias("path"),
                    F.regexp_extract_all(text, F.lit(_TOKEN), 0).alias("parts"))

    def at(i: Column) -> Column:
        return F.translate(F.get("parts", i), _MARKS, "")
    places = F.filter(F.sequence(F.lit(0), F.size("parts") - 1), lambda i: (
        F.length(F.get("parts", i)) >= min_length) | F.startswith(F.get("parts", i), F.lit("\x01")))

    def finding(i: Column) -> Column:
        return F.struct(i.alias("token"), at(i).alias("part"),
                        F.startswith(F.get("parts", i), F.lit("\x01")).alias("marked"),
                        F.concat_ws(" ", at(i - 3), at(i - 2), at(i - 1)).alias("left"),
                        F.concat_ws(" ", at(i + 1), at(i + 2)).alias("after"))
    t = t.where(F.size("parts") > 0).select("doc_id", "path", F.explode(F.transform(places, finding)).alias("c"))
    t = t.select("doc_id", "path", "c.*").withColumn("pieces", F.split("part", _PIECES))
    last = F.size("pieces") - 1

    def piece(x: Column, j: Column) -> Column:
        ends = F.when(j < last, F.regexp_replace(x, r"[^A-Za-z0-9+_]+$", "")).otherwise(x)
        # the pieces before it in its run are context, as in key=value
        head = F.array_join(F.slice("pieces", F.greatest(F.lit(1), j - 3), F.least(j, F.lit(4))), "")
        short = F.when(F.col("marked") & (j == 0), short_length).otherwise(min_length)
        return F.struct(F.regexp_replace(ends, r"^[./@-]+|[.:/@-]+$", "").alias("value"),
                        F.when(j > 0, head).alias("head"), short.alias("least"))
    whole = F.struct(F.when(F.col("marked"), F.col("part")).otherwise(
        F.regexp_replace("part", r"^[./@-]+|[.:/@-]+$", "")).alias("value"), F.lit(None).cast("string").alias("head"),
        F.when(F.col("marked"), short_length).otherwise(min_length).alias("least"))
    # user:password@host without a scheme: the password is a piece too
    passwords = F.transform("pieces", lambda x, j: piece(F.when(j > 0, F.regexp_extract(x, "^(.+)@[A-Za-z0-9]", 1)), j))
    found = F.array_distinct(F.concat(F.array(whole), F.transform("pieces", piece), passwords))
    found = F.filter(found, lambda x: F.length(x["value"]) >= x["least"])
    t = t.select("doc_id", "token", "left", "after", "path", F.explode(found).alias("f"))
    return t.select("doc_id", "token", F.col("f.value").alias("value"),
                    F.concat_ws(" ", "left", "f.head").alias("before"), "after", "path")


def features(found: DataFrame) -> DataFrame:
    """``found`` with the forest's input columns."""
    v, size = F.col("value"), F.length("value").cast("double")
    low = F.lower(v)

    def share(chars: str, of: Column = v) -> Column:
        return 1 - F.length(F.translate(of, chars, "")) / size

    def runs(of: Column) -> Column:
        return F.length(F.regexp_replace(of, r"(.)\1+", "$1"))
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kinds = F.translate(v, digits + lower + upper, "0" * 10 + "a" * 26 + "A" * 26)
    vowels = F.translate(low, "bcdfghjklmnpqrstvwxyz" + "aeiou", "b" * 21 + "a" * 5)
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    letters = F.transform(F.split(v, "[^A-Za-z]+"), lambda x: F.length(x))
    return found.select(
        "*", F.log2(size).alias("len"), share(digits).alias("digits"), share(upper).alias("uppers"),
        share("+/_=.@-").alias("symbols"), share(digits + "abcdef", low).alias("hex"),
        (F.size(F.array_distinct(F.split(v, ""))) / F.sqrt(size)).alias("distinct"),
        (runs(kinds) / size).alias("turns"), (runs(vowels) / size).alias("vowel_turns"),
        (F.array_max(letters) / size).alias("longest_letters"),
        (1 - F.length(F.regexp_replace(low, words, "")) / size).alias("dictionary"),
        F.col("path").rlike(_PATH).cast("double").alias("test_path"),
        F.col("before").rlike(_CREDENTIAL).cast("double").alias("credential"),
        F.col("before").rlike(_CHECKSUM).cast("double").alias("checksum"),
        F.rtrim("before").rlike(_ASSIGN).cast("double").alias("assigned"),
        v.rlike(r"(^[^@]*@[A-Za-z0-9-]+(\.|$|[:/])|://|www\.|\.(com|org|net|html?)\b)").cast("double").alias("address"),
        F.length(F.regexp_replace("after", "[^A-Za-z]", "")).cast("double").alias("after_words"),
        (F.col("before").rlike(r"://[^\s/@]*:$") & F.startswith("after", F.lit("@"))).cast("double").alias("userinfo"),
        # symbols inside, unless it refers to a value
        (v.rlike(r"[!#$%^&*~?|@][A-Za-z0-9!#$%^&*~?|@]") & ~v.rlike(r"^([$%][({A-Za-z_]|[{<\[])")).cast("double").alias("mixed"))


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` (with features) with ``label``: 1.0, 0.0 or NULL."""
    named = (F.col("credential") == 1) & (F.col("assigned") == 1)
    # a short number alone is as often a count
    number = (F.length("value") < MIN_LENGTH) & ~F.col("value").rlike("[^0-9.,]")
    random = ((F.col("digits") > 0.1) | (F.col("mixed") == 1)) & (F.col("dictionary") < 0.5) & (F.col("address") == 0) & ~number
    known = F.col("value").rlike(_FORMAT) | ((F.col("userinfo") == 1) & (F.col("dictionary") < 0.5))
    prose = ((F.col("digits") == 0) & (F.col("mixed") == 0)) | (F.col("address") == 1) | (F.col("dictionary") > 0.6)
    other = (F.col("checksum") == 1) & (F.col("credential") == 0)
    return found.withColumn("label", F.when(known | (named & random), 1.0).when(prose | other, 0.0))


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS, trees: int = 24, depth: int = 7,
        seed: int = 5) -> RandomForestClassificationModel | None:
    """Learn from findings with features and ``label``; distinct values with
    the smallest seeded hash, ``max_rows`` of each label. None where one label
    is missing."""
    order = F.xxhash64(F.lit(seed), "value")
    kept = labelled.where(F.col("label").isNotNull()).select(
        "label", "value", *[F.col(f).cast("float").alias(f) for f in FEATURES]).withColumn("order", order)
    kept = kept.groupBy("label", "value").agg(F.min(F.struct("order", *FEATURES)).alias("x"))
    kept = kept.select("label", "value", "x.*")
    one = [kept.where(F.col("label") == y).orderBy("order", "value").limit(max_rows) for y in (0.0, 1.0)]
    rows = stage(one[0].unionByName(one[1]), "secret-findings")
    if rows.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth,
                                    seed=seed, subsamplingRate=0.8, featureSubsetStrategy="sqrt")
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.orderBy("order", "value"))
    return forest.fit(data.select("features", "label"))


def score(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` (with features) with ``score``, the forest's vote for secret."""
    if model is None:
        return weak_labels(found).withColumn("score", F.coalesce("label", F.lit(0.0))).drop("label")
    data = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(found)
    model = model.setFeaturesCol("_features").setProbabilityCol("_votes").setRawPredictionCol("").setPredictionCol("")
    return model.transform(data).withColumn("score", vector_to_array("_votes")[1]).drop("_features", "_votes")


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, **columns) -> DataFrame:
    """(doc_id, token, value, before, after, path, score) of the findings that
    the forest keeps. ``labelled``: findings with features and label; weak
    labels of the documents' own findings where not given."""
    found = features(candidates(docs, **columns))
    found = stage(found, "secret-candidates", {"compression": "zstd"})
    model = fit(weak_labels(found) if labelled is None else labelled)
    return score(found, model).where(F.col("score") >= threshold).select(
        "doc_id", "token", "value", "before", "after", "path", "score")


def redact(docs: DataFrame, mask: str = "<SECRET>", id_col: str = "doc_id", text_col: str = "text",
           size_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with found secrets masked in the texts; ``size_col``, where
    there is such a column, is the masked text's length."""
    # rows are told apart by id and text, so a NULL id has a key too; rows that share a key share their secrets
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(id_col, text_col))
    found = scan(keyed, id_col=key, text_col=text_col, **options)
    longest = F.array_sort(F.collect_set(F.struct((-F.length("value")).alias("n"), "value")))
    found = stage(found.groupBy(F.col("doc_id").alias("_finding")).agg(longest.alias("_secrets")), "secret-values")
    # a found value stands in the text as such; longer ones are masked first
    text = F.when(F.col("_secrets").isNull(), F.col(text_col)).otherwise(
        F.aggregate("_secrets", F.col(text_col), lambda s, x: F.replace(s, x["value"], F.lit(mask))))
    out = keyed.join(found, keyed[key] == found["_finding"], "left").withColumn(text_col, text)
    if size_col and size_col in docs.columns:
        size = F.when(F.col("_secrets").isNull(), F.col(size_col)).otherwise(F.length(text_col))
        out = out.withColumn(size_col, size.cast(docs.schema[size_col].dataType))
    return out.select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The kept findings without the secrets themselves."""
    return scan(docs).select("doc_id", "token", F.length("value").cast("long").alias("length"),
                             F.sha2("value", 256).alias("value_sha256"), "score")
