"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

A candidate is a run of 16 and more key characters with a letter and a digit, or a quoted or bare value assigned to
a name such as token, secret or password. The forest sees its length, character transitions,
composition, dictionary coverage, whether it looks like a path or host, and its neighbouring words.
It is trained from labelled findings: the caller's, or ``LABELLED`` generated ones, which Spark makes
from hashes in the usual shapes of keys and of harmless look-alikes.

Everything is DataFrame functions and MLlib. Finding and scoring move no text; only documents with a
candidate are joined with their accepted findings, by a hash of the text, when secrets are blanked.

Defined results: null and empty texts have no findings. Repeated rows have the same findings each.
The two private marker characters (U+0001, U+0002) count as one ordinary character each if a text
holds them. Other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import text_of

LABELLED = 6_000
ACCEPT = 0.5
BLANKED = "[SECRET]"
NAMES = r"token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credentials?|client[_-]?secret"
# An equals sign only ends a key, as padding; before one stands a name.
KEY = r"(?<![A-Za-z0-9+/_.\-])(?=[A-Za-z+/_.\-]*+[0-9])(?=[0-9+/_.\-]*+[A-Za-z])[A-Za-z0-9+/_.\-]{16,}={0,2}"
ASSIGNED = rf"((?<![A-Za-z0-9_.\-])[A-Za-z0-9_.\-]{{0,64}}(?i:{NAMES})[A-Za-z0-9_.\-]{{0,64}}[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?)([^\s\"',;]{{6,}})"
# The password of a user in an address: scheme://user:password@host.
LOGIN = r"((?<![A-Za-z0-9+.\-])[A-Za-z][A-Za-z0-9+.\-]{1,31}://[^\s/:@\"']{0,64}:)([^\s/@\"']{3,128})(?=@)"
PATTERN = f"{ASSIGNED}|{LOGIN}|({KEY})"
BEFORE, AFTER = 48, 24

# Words whose letters count as dictionary coverage; parts of hosts, paths, names and placeholders.
DICTIONARY = (
    "the and for with from this that your here user name test demo example sample default change password secret token "
    "value none null true false file mail host http https www com net org html index image page data json config env "
    "key api id access account admin login client server local version release build commit section report number "
    "some any insert todo dummy fake placeholder xxxx aaaa 0000 1234"
).split()
HARMLESS = r"(?i)commit|sha-?\d*|md5|checksum|digest|hash|uuid|guid|version|revision|etag|example|sample|build|integrity"


def _features(df: DataFrame) -> DataFrame:
    """Adds the forest's columns to rows of before, candidate and after."""
    c, low = F.col("candidate"), F.lower("candidate")
    n = F.greatest(F.length(c), F.lit(1))
    # Digits first, so that the class letters are not taken for text.
    classes = F.translate(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9]", "."), r"[0-9]", "0"), r"[a-z]", "a"),
        "BCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 25,
    )
    count = lambda pattern: F.length(F.regexp_replace(c, pattern, ""))
    made = {
        "f_length": n.cast("double"),
        "f_transitions": F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) / n,
        "f_digits": count(r"[^0-9]") / n,
        "f_upper": count(r"[^A-Z]") / n,
        "f_symbols": count(r"[A-Za-z0-9]") / n,
        "f_hex": F.when(c.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$"), 1.0).otherwise(0.0),
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / F.least(n, F.lit(64)),
        "f_vowels": count(r"[^aeiouAEIOU]") / n,
        "f_longest": F.coalesce(F.array_max(F.transform(F.split(c, r"[^A-Za-z]+"), lambda w: F.length(w))), F.lit(0)) / n,
        "f_dictionary": 1 - F.length(F.regexp_replace(low, "|".join(DICTIONARY), "")) / n,
        "f_slashes": count(r"[^/\\]").cast("double"),
        "f_dots": count(r"[^.]").cast("double"),
        "f_dashes": count(r"[^\-_]").cast("double"),
        "f_ending": F.when(low.rlike(r"\.(com|net|org|edu|gov|io|html?|php|py|js|css|png|jpe?g|gif|txt|md|pdf|zip|gz|json|xml)\b"), 1.0).otherwise(0.0),
        "f_uuid": F.when(low.rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), 1.0).otherwise(0.0),
        "f_known": F.when(c.rlike(r"^(AKIA|ASIA|gh[pousr]_|sk[_-]|pk_live|rk_live|xox[abpr]-|AIza|eyJ|glpat-|npm_|SG\.)"), 1.0).otherwise(0.0),
        "f_call": F.when(c.rlike(r"[(){}\[\]<>$%]"), 1.0).otherwise(0.0),
        "f_named": F.when(F.col("before").rlike(rf"(?i)({NAMES})[\"'\w.\-]{{0,64}}\s{{0,3}}[:=]?\s{{0,3}}[\"']?$"), 1.0).otherwise(0.0),
        "f_assigned": F.when(F.col("before").rlike(r"[:=]\s*[\"']?$"), 1.0).otherwise(0.0),
        "f_quoted": F.when(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']"), 1.0).otherwise(0.0),
        "f_near": F.when(F.col("before").rlike(rf"(?i)({NAMES})"), 1.0).otherwise(0.0),
        "f_harmless": F.when(F.col("before").rlike(HARMLESS), 1.0).otherwise(0.0),
        "f_login": F.when(F.col("before").rlike(r"://[^\s/:@]*:$") & F.col("after").startswith("@"), 1.0).otherwise(0.0),
        "f_address": F.when(F.col("before").rlike(r"(://\S*|@|www\.)$"), 1.0).otherwise(0.0),
    }
    return df.withColumns({k: v.cast("double") for k, v in made.items()})


FEATURES = (
    "length transitions digits upper symbols hex distinct vowels longest dictionary slashes dots dashes ending uuid known "
    "call named assigned quoted near harmless login address"
).split()


def labelled_findings(spark: SparkSession, rows: int = LABELLED) -> DataFrame:
    """before, candidate, after, label: generated keys in their usual places, and look-alikes."""
    h = F.sha2(F.concat(F.lit("finding"), F.col("id").cast("string")), 512)
    b62 = F.regexp_replace(F.base64(F.unhex(h)), r"[+/=]", "")
    pick = lambda values, shift=0: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.xxhash64("id", F.lit(shift)), F.lit(len(values))) + 1).cast("int"))
    name = pick(["token", "api_key", "API_KEY", "secret", "password", "access_key", "client_secret", "auth_token", "apikey", "passwd"], 1)
    sign = pick([' = "', '="', ": ", " = ", "=", '": "', ": '", "='"], 2)
    lead = pick(["en der of ", "config: ", "and then the ", "les que ", "export ", "", "de la ", "{ ", "set "], 3)
    word = lambda s: pick(["mail", "report", "index", "section", "image", "volume", "chapter", "ontario", "thstere", "verunge", "layout", "module", "release", "cionado"], s)
    number = lambda m, s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(m)).cast("string")
    env = pick(["GITHUB_TOKEN=", "AWS_SECRET_ACCESS_KEY=", "DB_PASSWORD=", "S3_SECRET_KEY_2=", "app.auth-token.value=", "STRIPE_API_KEY="], 41)
    login = F.concat(lead, pick(["postgres", "mysql", "amqp", "redis", "https", "ftp", "mongodb"], 46), F.lit("://"), word(47), F.lit(":"))
    host = F.concat(F.lit("@"), word(48), F.lit(".net:5432/"), word(49))
    short = F.concat(word(50), number(99, 51), pick(["!", "#", "$", "?", "&"], 52), F.substring(b62, 1, 1))
    named, plain, close = F.concat(lead, name, sign), F.concat(lead, word(4), F.lit(" ")), pick(['"', "'", " ", "\n", ""], 5)
    true = [
        (named, F.substring(h, 1, 40)), (named, F.substring(h, 1, 32)), (named, F.substring(h, 1, 64)),
        (named, F.substring(b62, 1, 40)), (named, F.substring(b62, 1, 24)), (named, F.substring(b62, 1, 20)),
        (named, F.concat(F.substring(b62, 1, 11), F.lit("!"), number(90, 6))),
        (F.concat(lead, F.lit("key ")), F.concat(F.lit("AKIA"), F.upper(F.substring(b62, 1, 16)))),
        (plain, F.concat(F.lit("ghp_"), F.substring(b62, 1, 36))), (plain, F.concat(F.lit("sk_live_"), F.substring(b62, 1, 24))),
        (F.concat(lead, F.lit("Authorization: Bearer ")), F.concat(F.lit("eyJ"), F.substring(b62, 1, 33), F.lit("."), F.substring(b62, 20, 30))),
        (F.concat(lead, F.lit("token ")), F.substring(h, 1, 40)),
        (named, short), (F.concat(lead, env), short), (F.concat(lead, env), short),
        (login, F.substring(b62, 1, 12), host), (login, short, host),
        (F.concat(lead, env), F.substring(b62, 1, 40)), (F.concat(lead, env), F.concat(F.substring(b62, 1, 8), F.lit("!"), number(90, 42))),
        (F.concat(lead, F.lit("GITHUB_TOKEN=")), F.concat(F.lit("ghp_"), F.substring(b62, 1, 36))),
        (F.concat(lead, pick(["AWS_ACCESS_KEY_ID=", "id=", "AWS_ID="], 43)), F.concat(F.lit("AKIA"), F.upper(F.substring(b62, 1, 16)))),
    ]
    false = [
        (F.concat(lead, F.lit("that.92@")), F.concat(word(7), number(99, 8), F.lit(".example.com"))),
        (F.concat(lead, F.lit("https://www.")), F.concat(word(9), number(999, 10), F.lit(".example.org/"), word(11), F.lit("/"), number(9999, 12))),
        (plain, F.concat(word(13), F.lit("/"), word(14), F.lit("/"), word(15), number(99, 16), F.lit(".html"))),
        (F.concat(lead, F.lit("commit ")), F.substring(h, 1, 40)), (F.concat(lead, F.lit("sha256: ")), F.substring(h, 1, 64)),
        (F.concat(lead, F.lit('md5 = "')), F.substring(h, 1, 32)),
        (plain, F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))),
        (plain, F.concat(word(17), F.initcap(word(18)), F.initcap(word(19)), number(999, 20))),
        (plain, F.concat_ws("_", word(21), word(22), word(23), number(99, 24))),
        (named, F.concat(F.lit("your_"), name, F.lit("_here"))), (named, F.concat(pick(["x", "0", "a", "*"], 25), F.repeat(pick(["x", "0", "*"], 26), 19))),
        (named, F.concat(word(27), F.lit("_example_"), number(999, 28))), (named, F.concat(F.lit("os.environ["), name, F.lit("]"))),
        (named, F.concat(F.lit("${"), F.upper(name), F.lit("}"))), (named, pick(["changeme", "password", "required", "undefined", "None,None", "default", "example-token-1234"], 29)),
        (plain, F.concat(F.lit("v"), number(9, 30), F.lit("."), number(99, 31), F.lit(".0-"), word(32), F.lit("-"), number(999, 33))),
        (plain, F.concat(word(34), F.lit("..."), word(35), F.lit("..."), number(99, 36))),
        (plain, F.substring(h, 1, 40)),
        (login, pick(["password", "guest", "anonymous", "<password>", "${PASSWORD}", "changeme", "user"], 53), host),
        (F.concat(lead, env), pick(["changeme", "your_token_here", "${SECRET_TOKEN}", "example-token-1234", "placeholder"], 44)),
        (F.concat(lead, pick(["BUILD_COMMIT=", "GIT_SHA=", "version="], 45)), F.substring(h, 1, 40)),
    ]
    # Most of what a text's words before the sign say is left to chance by the lead.
    kinds = true + false
    at = F.pmod(F.xxhash64("id", F.lit(40)), F.lit(len(kinds)))
    kinds = [(*k, close) if len(k) == 2 else k for k in kinds]
    choose = lambda i: F.element_at(F.array(*[k[i] for k in kinds]), (at + 1).cast("int"))
    return spark.range(rows).select(
        F.col("id"), choose(0).alias("before"), choose(1).alias("candidate"), choose(2).alias("after"),
        F.when(at < len(true), 1.0).otherwise(0.0).alias("label"),
    ).where(F.length("candidate") >= 3)


def candidates(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per candidate: the kept columns, start (code points from 0), candidate, before, after."""
    text = F.translate(text_of(text_col), "\x01\x02", "��")
    pieces = F.split(F.regexp_replace(text, PATTERN, "$1$3\x01$2$4$5\x02"), "\x01")
    ends = F.aggregate(
        F.col("_pieces"),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("ends")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(F.replace(p, F.lit("\x02"), F.lit("")))).alias("at"),
            F.array_append(acc["ends"], acc["at"] + F.length(F.replace(p, F.lit("\x02"), F.lit("")))).alias("ends"),
        ),
    )["ends"]
    found = F.transform(
        F.sequence(F.lit(1), F.size("_pieces") - 1),
        lambda i: F.struct(
            F.get("_ends", i - 1).alias("start"),
            F.substring_index(F.get("_pieces", i), "\x02", 1).alias("candidate"),
            F.right(F.replace(F.get("_pieces", i - 1), F.lit("\x02"), F.lit("")), F.lit(BEFORE)).alias("before"),
            F.left(F.substring_index(F.get("_pieces", i), "\x02", -1), F.lit(AFTER)).alias("after"),
        ),
    )
    marked = docs.select(*keep, pieces.alias("_pieces")).where(F.size("_pieces") > 1)
    return marked.withColumn("_ends", ends).select(*keep, F.explode(found).alias("_f")).select(*keep, "_f.*")


def train(labelled: DataFrame, trees: int = 40, depth: int = 8) -> PipelineModel:
    forest = RandomForestClassifier(
        featuresCol="_vector", labelCol="label", numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="sqrt",
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
    )
    assembler = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="_vector")
    return Pipeline(stages=[assembler, forest]).fit(_features(labelled).repartition(1, "id") if "id" in labelled.columns else _features(labelled))


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), model: PipelineModel | None = None) -> DataFrame:
    """The candidates with ``score`` and ``is_secret``."""
    model = model or train(labelled_findings(docs.sparkSession))
    found = _features(candidates(docs, text_col, keep))
    return model.transform(found).withColumn("score", vector_to_array("_probability")[1]).select(
        *keep, "start", "candidate", "before", "after", "score", (F.col("score") >= ACCEPT).alias("is_secret")
    )


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_chars, candidate_sha256, score and is_secret of every candidate."""
    return scan(docs).select(
        "doc_id", "start", F.length("candidate").alias("n_chars"), F.sha2("candidate", 256).alias("candidate_sha256"),
        F.round("score", 6).alias("score"), "is_secret",
    )


def blank_secrets(docs: DataFrame, text_col: str = "text", model: PipelineModel | None = None) -> DataFrame:
    """The documents with each accepted secret replaced by ``BLANKED``."""
    has = text_of(text_col).rlike(PATTERN)
    # The caller's columns travel in one struct, so that none of their names can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    touched = docs.where(has).select(row, text_of(text_col).alias("text"), F.sha2(text_of(text_col), 256).alias("hash"))
    accepted = scan(touched, "text", ("hash",), model).where("is_secret").select(
        "hash", F.struct("start", F.length("candidate").alias("n")).alias("span")
    ).distinct().groupBy("hash").agg(F.sort_array(F.collect_list("span"), asc=False).alias("spans"))
    text = F.aggregate(
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,n:int>>")), F.col("text"),
        lambda t, s: F.concat(
            F.substring(t, F.lit(1), s["start"].cast("int")), F.lit(BLANKED),
            F.substring(t, (s["start"] + s["n"] + 1).cast("int"), F.length(t)),
        ),
    )
    blanked = touched.join(accepted, "hash", "left")
    old = lambda c: F.col("row").getField(c)
    new = F.when(F.col("spans").isNull(), old(text_col)).otherwise(text)
    return docs.where(~has).unionByName(blanked.select(*[(new if c == text_col else old(c)).alias(c) for c in docs.columns]))
