"""Secret scans with a random forest that removes false positives, in DataFrame functions only.

Candidates are runs of letters, digits and ``+/_-`` anywhere in a text: all that follow a credential word or are assigned, whatever their length and
letters, and of the others those that are no plain words: with digits, many capitals in a row or many changes of case. A forest judges them by
length, form, character classes and transitions between them, coverage by words that are frequent in the documents, the path, and the
words beside them. It is trained from labelled findings: given ones, or those that rules label.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import saved, whole_text

#: Of runs that nothing names or assigns.
LEAST_LENGTH = 12
#: Words that stand for a language: the most frequent of at least four letters.
DICTIONARY_WORDS = 300
#: Labelled findings of each kind that a forest is trained on, at most; those whose hash is smallest.
TRAINING_FINDINGS = 5000
TREES, DEPTH = 20, 6
PATH_BUCKETS = 16
KEEP_FROM = 0.5

_OPAQUE = r"[0-9]|[A-Z]{16}|(?:[a-z][A-Z].*?){3}"
#: Characters of the text on either side of a candidate, at most.
BESIDE = 64
# What stands before a run, and the run, with the signs that fill up base64; the last match is what stands behind all runs.
_PIECES = r"\G([^A-Za-z0-9+/_-]*+)([A-Za-z0-9+/_-]++(?:={1,2}(?![\"']?[A-Za-z0-9+/_=-]))?|\z)"
_ASSIGNED = r"[=:]>?[\s\"'`\\(\[{<]*$"

# Words beside credentials, samples, checksums and ids; forms of ids, checksums and well-known keys.
CREDENTIAL = r"(?i)(passw|passwd|passphrase|passcode|pwd|secret|token|api.?key|apikey|access.?key|auth|credential|bearer|private)"
SAMPLE = r"(?i)(?<![a-z])(examples?|samples?|dummy|placeholders?|tests?|x{4,}|your)(?![a-z])"
CHECKSUM = r"(?i)(?<![a-z])(commits?|revisions?|rev|sha-?[0-9]*|md5|etag|integrity|checksums?|digests?|hash(es)?|fingerprints?|blob|tree|uuid|guid|build|(request|trace|session|message|order|user)?[-_ ]?id)(?![a-z])"
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
DIGEST = r"^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})$"
INTEGRITY = r"^sha(1|224|256|384|512)-[A-Za-z0-9+/]+={0,2}$"
KNOWN_KEY = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^AIza[A-Za-z0-9_-]{35}$"

FEATURES = [
    "length", "digits", "capitals", "distinct", "hex", "turns", "case_turns", "vowel_turns",
    "coverage", "path_bucket", "credential_before", "credential_inside", "sample_beside", "assigned", "before_length", "behind_length",
    "checksum_beside", "uuid", "digest", "integrity",
]


def candidates(docs: DataFrame, doc_id: str = "doc_id", path: str = "source", text: str = "text") -> DataFrame:
    """``doc_id, path, place, before, candidate, behind`` of every run that is opaque, follows a credential word or is assigned.

    ``place`` counts the runs of the text, so that it tells the candidates of a text apart; ``before`` and ``behind`` are the text on
    either side, up to the second run before and the first one behind, of ``BESIDE`` characters at most.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all(whole_text(text), F.lit(_PIECES), 1).alias("gaps"),
        F.regexp_extract_all(whole_text(text), F.lit(_PIECES), 2).alias("runs"),
        whole_text(text).rlike(CREDENTIAL).alias("named"),
    )

    def piece(name: str, i: Column) -> Column:
        return F.coalesce(F.get(name, i), F.lit(""))

    def before(i: Column) -> Column:
        whole = F.concat(piece("runs", i - 2), piece("gaps", i - 1), piece("runs", i - 1), piece("gaps", i))
        return F.right(whole, F.lit(BESIDE))

    def wanted(i: Column) -> Column:
        run = F.get("runs", i)
        opaque = (F.length(run) >= LEAST_LENGTH) & run.rlike(_OPAQUE)
        assigned = F.get("gaps", i).rlike(_ASSIGNED)
        return (run != "") & (opaque | assigned | (F.col("named") & before(i).rlike(CREDENTIAL)))

    def found(i: Column) -> Column:
        return F.struct(
            i.alias("place"),
            before(i).alias("before"),
            F.get("runs", i).alias("candidate"),
            F.left(F.concat(piece("gaps", i + 1), piece("runs", i + 1)), F.lit(BESIDE)).alias("behind"),
        )

    places = F.filter(F.sequence(F.lit(0), F.size("runs") - 1), wanted)
    return rows.select("doc_id", "path", F.explode(F.transform(places, found)).alias("found")).select("doc_id", "path", "found.*")


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY_WORDS) -> list[str]:
    """The words that most documents hold, of four to twelve letters, over all documents; ties go by the alphabet."""
    own = F.array_distinct(
        F.filter(F.split(F.lower(whole_text(text)), r"\s+"), lambda w: F.length(w).between(4, 12) & w.rlike(r"^\p{L}+$"))
    )
    counts = docs.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    length = F.length("candidate").cast("double")
    covering = "|".join(sorted(words, key=len, reverse=True))
    left = F.regexp_replace(F.lower("candidate"), covering, "") if words else F.col("candidate")
    return found.withColumns(
        {
            "length": length,
            "digits": _share("[0-9]"),
            "capitals": _share("[A-Z]"),
            "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / length,
            "hex": _share("[0-9a-fA-F]"),
            "turns": _share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
            "case_turns": _share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
            "vowel_turns": _share("(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])"),
            "coverage": 1 - F.length(left) / length,
            "path_bucket": F.pmod(F.xxhash64("path"), F.lit(PATH_BUCKETS)).cast("double"),
            "credential_before": F.col("before").rlike(CREDENTIAL).cast("double"),
            "credential_inside": F.col("candidate").rlike(CREDENTIAL).cast("double"),
            "sample_beside": F.concat("before", "candidate", "behind").rlike(SAMPLE).cast("double"),
            # What follows the colon of a URL's scheme is not assigned.
            "assigned": (F.col("before").rlike(_ASSIGNED) & ~F.col("candidate").startswith("//")).cast("double"),
            "before_length": F.length("before").cast("double"),
            "behind_length": F.length("behind").cast("double"),
            "checksum_beside": F.col("before").rlike(CHECKSUM).cast("double"),
            "uuid": F.col("candidate").rlike(UUID).cast("double"),
            "digest": F.col("candidate").rlike(DIGEST).cast("double"),
            "integrity": F.col("candidate").rlike(INTEGRITY).cast("double"),
        }
    )


def rule_label() -> Column:
    """Labels of findings that need no judgement: well-known keys and assigned credentials are secrets; numbers, samples,
    words of the language, and checksums and ids that no credential word names are not. Null for all others, which only the
    forest judges."""
    opaque = (F.col("length") >= 16) & (F.col("digits") > 0.1) & (F.col("coverage") < 0.3)
    # Passwords may be shorter; those of one case and no digits are left to the forest, as a word that the dictionary lacks looks the same.
    mixed = F.col("candidate").rlike("[A-Za-z].*[0-9]|[0-9].*[A-Za-z]") | (F.col("case_turns") > 0.4)
    short = (F.col("length") >= 8) & mixed & (F.col("coverage") < 0.3) & (F.col("credential_inside") == 0)
    named = (F.col("credential_before") > 0) & (F.col("assigned") > 0)
    of_form = (F.col("uuid") > 0) | (F.col("integrity") > 0) | ((F.col("digest") > 0) & (F.col("checksum_beside") > 0))
    return (
        F.when(F.col("candidate").rlike(KNOWN_KEY), 1.0)
        .when(F.col("sample_beside") > 0, 0.0)
        .when((F.col("credential_before") == 0) & of_form, 0.0)
        .when(named & (opaque | short), 1.0)
        .when((F.col("digits") == 1) | (F.col("coverage") > 0.6) | F.col("candidate").rlike("^[A-Za-z]+[0-9]{1,4}$"), 0.0)
    )


def train(findings: DataFrame, training: int = TRAINING_FINDINGS) -> PipelineModel | None:
    """A forest from findings with features and ``label``; None unless there are labels of both kinds."""
    labelled = findings.filter("label IS NOT NULL").select("label", "doc_id", "place", *FEATURES)
    order = F.xxhash64("doc_id", "place"), F.col("place")
    rows = saved(labelled.filter("label = 1").orderBy(*order).limit(training), "secrets").unionByName(
        saved(labelled.filter("label = 0").orderBy(*order).limit(training), "harmless")
    )
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=1)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(rows.coalesce(1))


def scan_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    path: str = "source",
    text: str = "text",
    labels: Column | DataFrame | None = None,
) -> DataFrame:
    """One row per candidate: ``doc_id, path, place, candidate, probability, is_secret``.

    ``labels`` are findings that someone has judged, as a frame ``doc_id, place, label`` with labels 1 and 0, or a column that
    labels findings by their features (1, 0 or null); ``rule_label`` by default. At most ``TRAINING_FINDINGS`` of each label are
    used. A finding that is labelled twice counts once if the labels agree; where they differ, it trains nothing. ``is_secret`` is false for the candidates that
    the forest removes. Without labels of both kinds no forest can be trained: then the probability is null and all
    candidates stay. A null text is empty, a null path the empty path; neither has candidates of its own. Rows that
    repeat an id are scanned each; an empty table gives an empty result. Other columns are not read.
    """
    words = dictionary(docs, text)
    found = saved(with_features(candidates(docs, doc_id, path, text), words), "findings")
    if isinstance(labels, DataFrame):
        judged = labels.groupBy("doc_id", "place").agg(F.min("label").cast("double").alias("label"), F.max("label").cast("double").alias("other"))
        agreed = judged.filter("label = other").drop("other")
        found = found.join(agreed, ["doc_id", "place"], "left")
    else:
        found = found.withColumn("label", rule_label() if labels is None else labels)
    model = train(found)
    if model is None:
        judged = found.withColumn("probability", F.lit(None).cast("double"))
    else:
        judged = model.transform(found).withColumn("probability", vector_to_array("probability")[1])
    return judged.select(
        "doc_id", "path", "place", "candidate", "probability", F.coalesce(F.col("probability") >= KEEP_FROM, F.lit(True)).alias("is_secret")
    )
