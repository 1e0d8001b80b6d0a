"""Secret scans: candidates by shape, false positives removed by a random forest.

Candidates are runs of at least `LEAST_LENGTH` token characters with a digit, and behind a secret's name and
its assignment sign the value, whatever its length and characters. The forest sees length,
transitions between character classes, character statistics, how much of the candidate is made of dictionary
words, the path of the document and the words around. It is trained from labelled findings: a table of
(text before, candidate, text after, path, label), or, where none is given, two halves. One are findings made by
`planted_findings`, whose label is how they were made: random keys in the places where keys stand, and what scanners
take for them, among it stand-ins, made-up passwords of words, digests and identifiers with a secret's name before them.
The other are findings of the scanned documents that fixed rules can label (a value with a digit or in quotes
that is assigned to a secret's name, or a known key format; a call or stand-in assigned so, a plain number, a host
or mail name, a digest with its name). Where the two disagree, planted findings weigh more.

Only DataFrame and ML pipeline functions are used. Texts are searched once; their candidates, which are few, are
written, and everything else reads those. Training takes at most `MAX_TRAINING` findings of each half, those with
the smallest hashes, so its cost does not grow with the corpus.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import field, lower_ascii, set_aside, set_back, table, written_result
from stratiform.workspace import stage

LEAST_LENGTH = 16
CONTEXT = 60
MAX_TRAINING = 20_000
TREES, DEPTH, SEED = 30, 8, 11
#: Findings planted of each kind, and how much more one of them weighs than one labelled by rule.
PLANTED, PLANTED_WEIGHT = 200, 4.0
CUT = 0.5

#: Names that stand before a secret, before something harmless, and words that tokens of code are made of.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "auth", "credential", "bearer", "private")
HARMLESS_NAMES = ("sha", "commit", "md5", "hash", "checksum", "digest", "uuid", "guid", "revision", "isbn", "order", "invoice", "example")
DICTIONARY = (
    "example", "sample", "test", "name", "file", "path", "data", "user", "value", "class", "index", "table",
    "version", "number", "string", "default", "config", "build", "release", "image", "model", "page", "text",
    "with", "from", "this", "that", "have", "there", "which", "http", "https", "www", "com", "org",
)
KEY_FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$"

# What is proposed, tried in this order at every place:
# 1. behind a secret's name and its assignment sign, the value, however short and whatever it is made of (in
#    quotes also several words, unless a token of kind 2 is among them),
# 2. a run of at least `LEAST_LENGTH` token characters with a digit, '=' only as its padding,
# 3. such a run with '=' anywhere that holds none of the others.
# Look-behinds and look-aheads are bounded or stay in one run or line, the cheap ones first.
CLASS = "[A-Za-z0-9+/_-]"
LONG = "(?=[A-Za-z+/_-]*[0-9])" + CLASS + "{" + str(LEAST_LENGTH) + ",}+"
TOKEN = "(?<!" + CLASS + ")" + LONG + "(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
NAMES = "(?i:" + "|".join(SECRET_NAMES) + ")[A-Za-z0-9_-]{0,24}"
SIGN = "(?::=|=>|[:=])"
BEHIND_SIGN = "(?<=[:=> \\t\"'`])(?<=[:=>][ \\t]{0,4}[\"'`]?)"
NAMED = "(?<=" + NAMES + "[\"'`]?[ \\t]{0,4}" + SIGN + "[ \\t]{0,4}[\"'`]?)"
BARE = r"[^\s\"'`,;&<>(){}\[\]]"
# Without quotes: up to a blank, bracket or quote, or a separator with another field or nothing behind it; not a
# whole address that has fields itself.
PLAIN = "(?!" + BARE + r"*[?&][\w.-]+=)(?![=:])" + BARE + r"++(?:[,;&](?![\w.-]*[=:])" + BARE + "++){0,50}+"
# In quotes: up to the same quote.
QUOTED = "|".join(f"(?<={q})(?=[^{q}\\r\\n]+{q})(?!(?=[^{q}\\r\\n]*[ \\t])[^{q}\\r\\n]*{TOKEN})[^{q}\\r\\n]++" for q in "\"'`")
VALUE = BEHIND_SIGN + NAMED + "(?:" + QUOTED + "|" + PLAIN + ")"
INSIDE = "[A-Za-z0-9+/_=-]*=(?:" + LONG + "|(?<=" + NAMES + "=)" + CLASS + ")"
MIXED = "(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?!" + INSIDE + ")[A-Za-z0-9+/_=-]{" + str(LEAST_LENGTH) + ",}+"
CANDIDATE = VALUE + "|" + TOKEN + "|" + MIXED

# The words of HARMLESS_NAMES count for the features as whole words; so do those of SECRET_NAMES, which may
# be followed by an assignment.
ASSIGNED = r"(?:" + "|".join(SECRET_NAMES) + r")[a-z0-9_-]*[\"'`]?\s*(?:[:=]|:=|=>)\s*[\"'`]?$"
#: Values that only stand for one: code, placeholders, words about a secret.
STAND_INS = r"^(?:none|null|nil|true|false|undefined|string|str|text|bytes|int|any|optional|\$.*|%.*|\*+|x+|\.+)$"
NAMED_HARMLESS = r"\b(?:" + "|".join(HARMLESS_NAMES) + r")\w*\W{0,3}$"
FEATURES = [
    "length", "transitions", "distinct", "entropy", "digits", "uppers", "lowers", "others", "hexadecimal", "only_digits",
    "dictionary", "secret_near", "harmless_near", "assigned", "quoted", "mail_like", "path_like", "test_path", "path_depth",
]


def candidates(docs: DataFrame, text: str, path: str | None, keep: list[str]) -> DataFrame:
    """One row per candidate: the kept columns set aside, nth, before, candidate, after, path."""
    body = F.coalesce(field(docs, text).cast("string"), F.lit(""))
    where = F.coalesce(field(docs, path).cast("string"), F.lit("")) if path else F.lit("")
    found = docs.select(
        *set_aside(docs, keep),
        where.alias("path"),
        body.alias("body"),
        F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)).alias("found"),
    ).where(F.size("found") > 0)
    kept = [f"_kept{i}" for i in range(len(keep))]
    # What stands between the candidates, cut to the context before anything is exploded.
    pieces = F.split("body", CANDIDATE, -1)
    tail = lambda value: F.right(value, F.lit(CONTEXT))
    # A candidate may be the name that the next one is assigned to, so it belongs to what stands before that.
    before = lambda p, i: tail(F.concat(F.coalesce(tail(F.get("found", i - 1)), F.lit("")), tail(p)))
    around = F.transform(pieces, lambda p, i: F.struct(before(p, i).alias("before"), F.left(p, F.lit(CONTEXT)).alias("after")))
    cut = found.withColumn("around", around).drop("body")
    each = cut.select(*kept, "path", "around", F.posexplode("found").alias("nth", "candidate"))
    return each.select(
        *kept,
        "path",
        F.col("nth").cast("long").alias("nth"),
        "candidate",
        F.get("around", F.col("nth"))["before"].alias("before"),
        F.get("around", F.col("nth") + 1)["after"].alias("after"),
    )


def with_features(found: DataFrame) -> DataFrame:
    """The features of findings (before, candidate, after, path), all doubles."""
    c, before, after, path = F.col("candidate"), lower_ascii(F.col("before")), lower_ascii(F.col("after")), lower_ascii(F.col("path"))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), "[^lud]", "o")
    found = found.withColumn("_n", F.length(c).cast("double")).withColumn("_chars", F.split(c, ""))
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / F.col("_n")
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    covered = F.length(c) - F.length(F.regexp_replace(lower_ascii(c), "|".join(DICTIONARY), ""))
    counted = F.transform(F.array_distinct("_chars"), lambda x: (F.col("_n") - F.length(F.replace(c, x, F.lit("")))) / F.col("_n"))
    return found.select(
        "*",
        F.col("_n").alias("length"),
        (F.regexp_count(kinds, F.lit("l+|u+|d+|o+")) - 1).cast("double").alias("transitions"),
        (F.size(F.array_distinct("_chars")) / F.col("_n")).alias("distinct"),
        F.aggregate(counted, F.lit(0.0), lambda a, p: a - p * F.log2(p)).alias("entropy"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"),
        share("[a-z]").alias("lowers"),
        share("[^A-Za-z0-9]").alias("others"),
        flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hexadecimal"),
        flag(c.rlike("^[0-9]+$")).alias("only_digits"),
        (covered / F.col("_n")).alias("dictionary"),
        flag(before.rlike("|".join(SECRET_NAMES))).alias("secret_near"),
        flag(before.rlike(NAMED_HARMLESS)).alias("harmless_near"),
        flag(before.rlike(r"[:=]>?\s*[\"'`]?$")).alias("assigned"),
        flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).alias("quoted"),
        flag(before.rlike("@[a-z0-9.]*$") | after.rlike(r"^(@|\.[a-z])")).alias("mail_like"),
        flag(before.rlike(r"(://|/|\\|\.)$") | c.contains("/")).alias("path_like"),
        flag(path.rlike("test|example|sample|mock|fixture|doc")).alias("test_path"),
        F.regexp_count(path, F.lit("[/\\\\]")).cast("double").alias("path_depth"),
    ).drop("_n", "_chars")


def rule_label() -> Column:
    """1, 0, or null where no rule applies: the label of a finding that fixed rules can tell."""
    before, after, c = lower_ascii(F.col("before")), lower_ascii(F.col("after")), F.col("candidate")
    quoted = before.rlike("[\"'`]$") & after.rlike("^[\"'`]")
    return (
        F.when(c.rlike(KEY_FORMATS), 1)
        .when(c.rlike("^[0-9]+$") | before.rlike(NAMED_HARMLESS) | before.rlike("@[a-z0-9.]*$") | after.rlike(r"^(@|\.[a-z])"), 0)
        .when(before.rlike(ASSIGNED) & (lower_ascii(c).rlike(STAND_INS) | (after.rlike(r"^[(\[{]") & ~quoted)), 0)
        .when(before.rlike(ASSIGNED) & (c.rlike("[0-9]") | quoted), 1)
        .when(before.rlike(ASSIGNED), None)
        .when(before.rlike(r"(^|\s)$") & after.rlike(r"^(\s|$)") & c.rlike("^[A-Za-z]+[0-9]{1,4}$"), 0)
    )


def labelled(found: DataFrame) -> DataFrame:
    """Findings that the rules can label, with `label`."""
    return found.withColumn("label", rule_label()).where("label is not null")


def planted_findings(spark: SparkSession, each: int = PLANTED) -> DataFrame:
    """kind, before, candidate, after, path and label of made findings, `each` of every kind, the same in every run.

    A kind says how its findings were made and so what they are, whatever a rule would say of them.
    """
    n = F.col("id")
    digest = lambda salt: F.sha2(F.concat(n.cast("string"), F.lit(salt)), 256)
    pick = lambda salt, *values: F.get(F.array(*map(F.lit, values)), F.pmod(F.xxhash64(n, F.lit(salt)), F.lit(len(values))).cast("int"))
    key = lambda salt, size: F.left(F.translate(F.base64(F.unhex(digest(salt))), "+/=", "xyz"), F.lit(size))
    hexed = lambda salt, size: F.left(digest(salt), F.lit(size))
    name = pick("name", "api_token", "secret", "AWS_SECRET_KEY", "auth_token", "db_password", "private_key", "client_secret", "API_KEY")
    word = lambda salt: pick(salt, "changeme", "example", "password", "default", "sample", "letmein", "admin", "mysecret", "testuser", "string")
    uuid = F.concat_ws("-", *(F.substring(digest("uuid"), i, k) for i, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    code = pick("code", "src/app/settings.py", "deploy/prod.env", "lib/client.js", "ops/run.sh", "web")
    sample = pick("sample", "docs/readme.md", "tests/fixtures/a.json", "examples/config.yml", "test/mock.py", "doc")
    none = F.lit("")
    kinds = {
        "assigned key": (F.concat(name, F.lit(" = \"")), key("a", 40), F.lit("\"\n"), code, 1),
        "environment key": (F.concat(F.lit("export "), name, F.lit("=")), key("b", 32), F.lit("\n"), code, 1),
        "assigned digits of a key": (F.concat(name, F.lit(": ")), hexed("c", 32), F.lit("\n"), code, 1),
        "key in an address": (F.lit("https://host.example/v1/items?access_token="), hexed("d", 40), F.lit("&page=2"), code, 1),
        "key in a header": (F.lit("curl -H 'Authorization: Bearer "), key("e", 43), F.lit("' https"), code, 1),
        "short password": (F.lit("password = \""), F.concat(key("f", 5), F.lit("!"), key("g", 4)), F.lit("\"\n"), code, 1),
        "key of a known form": (pick("h", "use ", "id ", "with "), F.concat(F.lit("ghp_"), key("h", 36)), F.lit(" in"), code, 1),
        "key in prose": (F.lit("the token is "), key("i", 40), F.lit(" and expires"), none, 1),
        "stand-in": (F.concat(name, F.lit(" = \"")), F.concat(word("j"), pick("k", "1", "123", "2024", "_1")), F.lit("\"\n"), sample, 0),
        "stand-in of words": (F.concat(name, F.lit(": ")), F.concat_ws("-", F.lit("your"), word("l"), F.lit("token"), pick("m", "1", "here2", "goes3")), F.lit("\n"), sample, 0),
        "name of a setting": (F.concat(name, F.lit(" = ")), F.concat(F.lit("config_"), word("n"), F.lit("_value_"), pick("o", "1", "2", "3")), F.lit("\n"), code, 0),
        "digest under a token's name": (F.lit("token checksum sha256: "), hexed("p", 64), F.lit("\n"), code, 0),
        "commit": (pick("q", "commit ", "see revision ", "merge commit "), hexed("q", 40), F.lit(" in main"), none, 0),
        "identifier": (pick("r", "auth request id ", "uuid=", "order "), uuid, F.lit(" done"), code, 0),
        "number": (pick("s", "call ", "invoice ", "account "), F.translate(hexed("s", 16), "abcdef", "012345"), F.lit(" now"), none, 0),
        "words joined": (pick("t", "see ", "open ", "the "), F.concat_ws("_", word("u"), F.lit("file"), word("v"), pick("w", "v1", "v2", "v3")), F.lit(" for"), none, 0),
        "path": (F.lit("open https://host.example/"), F.concat_ws("/", F.lit("data"), word("x"), F.lit("release"), pick("y", "2023", "2024"), F.lit("index")), F.lit(".html"), none, 0),
    }
    made = F.array(
        *(
            F.struct(F.lit(kind).alias("kind"), b.alias("before"), c.alias("candidate"), a.alias("after"), p.alias("path"), F.lit(label).alias("label"))
            for kind, (b, c, a, p, label) in kinds.items()
        )
    )
    return spark.range(each).select(F.inline(made))


def assembled(featured: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured)


def smallest(findings: DataFrame, most: int) -> DataFrame:
    """At most so many findings, those with the smallest hashes."""
    return findings.orderBy(F.xxhash64("candidate", "before", "after", "path"), "candidate", "before", "after").limit(most)


def train_forest(findings: DataFrame, max_training: int = MAX_TRAINING) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (before, candidate, after, path, label, and weight if there is one); None if a label is missing."""
    weight = F.col("weight") if "weight" in findings.columns else F.lit(1.0)
    rows = with_features(smallest(findings, max_training))
    rows = stage(rows.select(*FEATURES, F.col("label").cast("double").alias("label"), weight.alias("weight")), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", weightCol="weight")
    return forest.fit(assembled(rows))


def own_findings(found: DataFrame, max_training: int = MAX_TRAINING) -> DataFrame:
    """Labelled findings where none are given: planted ones, and at most `max_training` that the rules label."""
    names = ["before", "candidate", "after", "path", "label"]
    planted = planted_findings(found.sparkSession).select(*names, F.lit(PLANTED_WEIGHT).alias("weight"))
    return planted.union(smallest(labelled(found), max_training).select(*names, F.lit(1.0).alias("weight")))


def scan_secrets(
    docs: DataFrame, text: str = "text", path: str | None = "source", findings: DataFrame | None = None, keep: list[str] | None = None, cut: float = CUT
) -> DataFrame:
    """One row per candidate: the columns `keep` (default: all), nth, length, digest, preview, score, secret.

    `nth` counts the candidates of a document from 0; `digest` is the SHA-256 of the candidate, so that a
    report holds no secret, and `preview` its first four characters. `score` is the forest's probability; a
    finding below `cut` is a false positive (secret false). Documents without candidates, null and empty texts
    have no rows; a null path counts as empty; repeated rows are scanned one by one. `findings` are learned from
    in place of planted and rule-labelled ones; if they lack a label there is no forest, and the fixed rules
    decide alone (score 1, 0, or 0.5 where none applies).
    Derived columns replace input columns of the same name.
    """
    keep = docs.columns if keep is None else keep
    found = stage(candidates(docs, text, path, keep), "candidates")
    model = train_forest(findings) if findings is not None else train_forest(own_findings(found), 2 * MAX_TRAINING)
    featured = with_features(found)
    if model is None:
        scored = featured.withColumn("score", F.coalesce(rule_label().cast("double"), F.lit(0.5)))
    else:
        scored = model.transform(assembled(featured)).withColumn("score", vector_to_array("probability")[1])
    derived = ["nth", "length", "digest", "preview", "score", "secret"]
    return scored.select(
        *set_back(keep, derived),
        "nth",
        F.length("candidate").cast("long").alias("length"),
        F.sha2("candidate", 256).alias("digest"),
        F.left("candidate", F.lit(4)).alias("preview"),
        F.round("score", 6).alias("score"),
        (F.round("score", 6) >= cut).alias("secret"),
    )


def op6_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return written_result(spark, "op6", lambda: scan_secrets(docs, keep=["doc_id"]))
