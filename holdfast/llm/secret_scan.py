"""Secret scans: candidate strings judged by a random forest, in DataFrame functions alone.

Candidates are long runs of key characters with a digit, values of six characters or more that are assigned to
the name of a credential, and such values between a user and a host (user:value@host). The forest looks at their length, character
transitions and classes, how much of them dictionary words cover (a word is in the dictionary by the number
of times it stands in the texts), the path they come from and the words around them. It is trained from
labelled findings; `labelled` builds a set by rule, and any other frame of texts, paths and labels will do.
"""

from __future__ import annotations

import base64
import random
import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import SPACED_WORD
from holdfast.llm.links import few
from holdfast.session import staged

# Tried at the start of a run only, without ways back: every character is looked at twice at most.
CANDIDATE = r"(?<![A-Za-z0-9_+/.-])(?=[A-Za-z_+/.-]*+[0-9])[A-Za-z0-9_+/.-]{16,}+={0,2}"
AROUND = 3  # words looked at on either side
NEAR = 200  # characters looked at of each of them, and of what stands before a value in its own word
TREES, DEPTH, SEED = 40, 8, 8
ACCEPT = 0.5
LABELLED = 1600  # findings built by rule; the bound of the training sample
COMMON = 5  # times a word stands in the texts to be in the dictionary
MASK = "[SECRET]"

# Words that tell of credentials, of examples, and of other long strings.
CREDENTIAL = "token|secret|passw|pwd|api.?key|apikey|auth|bearer|credential|access.?key|private.?key|client.?key|signature"
EXAMPLE = "example|sample|dummy|placeholder|your|changeme|fake|test|xxxx|redacted|todo"
OTHER = "commit|sha|hash|checksum|digest|md5|uuid|guid|version|http|www|mail|href|file|image|integrity|build|release|rev|tree"

# Candidates known by what stands before them; group 1 is that, group 2 the value. The value after a name runs to the
# closing quote, or to a blank, the next name or closing punctuation. Both skip what is masked already.
_OPEN, _CLOSE = "\x01", "\x02"
_FRESH = rf"(?!{re.escape(MASK)}(?![A-Za-z0-9]))"
_BARE = r"(?:(?![,;&][\w.-]+[=:]|[.,;:)\]}]{1,4}(?:[\s\"'`<>]|$))[^\s\"'`<>\x00-\x1F]){6,}+"
ASSIGNED = rf"((?i:{CREDENTIAL})[\w.-]{{0,40}}[\"'\]]*[ \t]*[=:]{{1,3}}>?[ \t]*[\"'`]?){_FRESH}((?<=\")[^\"\x00-\x1F]{{6,}}(?=\")|(?<=')[^'\x00-\x1F]{{6,}}(?=')|{_BARE})"
# What a run of login characters has before its last @ with a host is put between marks first; the value then
# reaches from the first user to that end, and no character is looked at from many starts.
_HEAD, _END = "\x04", "\x05"
_RUN = r"[^\s/\"'<>\x00-\x1F]"
HOSTED = rf"(?<!{_RUN})({_RUN}*)(?=@[A-Za-z0-9\[])"
LOGIN = rf"{_HEAD}({_RUN}*?(?:(?<![\w.%+-])[\w.%+-]{{1,64}}|(?<=//{_HEAD})):){_FRESH}({_RUN}{{6,}}+){_END}"


def labelled(spark: SparkSession, n: int = LABELLED, seed: int = SEED) -> DataFrame:
    """Labelled findings by rule: text, path and label (1 secret, 0 not), each text with one candidate."""
    rng = random.Random(seed)
    raw = lambda k: bytes(rng.randrange(256) for _ in range(k))
    hexa = lambda k: raw(k).hex()
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    letters = "abcdefghijklmnopqrstuvwxyz"
    mixed = letters + letters.upper() + "0123456789"
    filler = "the value of this is used in order to start a new run when all is well and done for each one".split()
    word = lambda: pick("aeioustrnlmd", rng.randint(2, 9))
    names = ["token", "secret", "password", "api_key", "apikey", "auth_token", "access_key", "client_secret", "private_key", "TOKEN", "API_KEY", "SECRET_KEY", "bearer"]
    login_names = ["password", "passwd", "pwd", "DB_PASSWORD", "db_pwd", "Password", "passwd", "secret", "auth", "credential"]
    marks = "!@#$%&*?"
    chosen = lambda: rng.choice([  # a password people choose: at least one of digits, marks and capitals
        lambda: word() + pick("0123456789", rng.randint(4, 6)), lambda: word().capitalize() + pick(marks, 1) + pick("0123456789", rng.randint(3, 4)),
        lambda: word().capitalize() + pick(marks, 1) + word().capitalize() + pick(marks, 1) + pick(letters, 2), lambda: pick(mixed + marks, rng.randint(8, 14)), lambda: pick(mixed, rng.randint(8, 15)),
        lambda: word() + pick(marks, 2) + pick(letters, 3) + pick("0123456789", 1), lambda: pick(letters, 2) + pick("0123456789", 1) + pick(letters, 1) + pick("0123456789", 1) + pick(letters, rng.randint(2, 5)) + pick(marks + "0123456789", 2),
    ])()
    rows = []
    for i in range(n):
        label = i % 2
        if label and i % 10 in (1, 5):
            core = rng.choice(["{k} = \"{v}\"", "{k}={v}", "{k}: '{v}'", "{k}: {v}", "\"{k}\": \"{v}\"", "export {k}={v}", "{s}://{u}:{v}@{h}/{w}", "{u}:{v}@{h}"]).format(
                k=rng.choice(login_names), v=chosen(), s=rng.choice(["postgres", "mysql", "ftp", "https", "redis"]), u=rng.choice(["user", "admin", "root", word()]), h=rng.choice(["host", "db", "localhost", word()]), w=word()
            )
            path = rng.choice(["src/app", "config/prod", "deploy", "web", "notes", "src1"])
        elif not label and i % 10 in (0, 4):
            said = word() + pick("aeioustrnlmd", 4)
            core = rng.choice([
                "{k}: {p}", "{k} = \"{p}\"", "{k}: {p} {p}", "\"{k}\": \"{p}\"", "{k} = get_{p}()", "{k} = os.environ['{q}']", "{k}: ${{{q}}}", "{k}=${q}", "{k} = config.{p}.{p}", "{k}: <{p}-here>",
                "mailto:{p}.{w}@{h}.org", "mail:{p}@{h}.com", "from:{p}@{h}.net", "{k} = \"changeme\"", "{k}: ********", "{k} = \"xxxxxx\"", "{k}: \"your {k} here\"", "{k}: {p}, {p}", "{k} = request.{p}[0]",
            ]).format(k=rng.choice(names + login_names), p=rng.choice([said, said, rng.choice(["required", "string", "optional", "always", "enabled", "Invalid", "Required", "nothing"])]), q=said.upper() + "_KEY", w=word(), h=word())
            path = rng.choice(["docs", "tests/data", "src/app", "web", "examples", "notes", "src1"])
        elif label:
            value = rng.choice([
                lambda: hexa(rng.choice([16, 20, 20, 32])), lambda: hexa(20).upper(), lambda: "AKIA" + pick(letters.upper() + "0123456789", 16), lambda: "ghp_" + pick(mixed, 36),
                lambda: "sk_live_" + pick(mixed, 24), lambda: base64.b64encode(raw(30)).decode().rstrip("="), lambda: pick(mixed, rng.randint(20, 48)),
                lambda: "eyJ" + pick(mixed, 30) + "." + pick(mixed, 40) + "." + pick(mixed, 30),
            ])()
            around = rng.choice(["{k} = \"{v}\"", "{k}={v}", "{k}: '{v}'", "{k}: {v}", "\"{k}\": \"{v}\"", "export {k}={v}", "{k} {v}"])
            core = around.format(k=rng.choice(names), v=value)
            path = rng.choice(["src/app", "config/prod", "deploy", "web", "notes", "src1"])
        else:
            kind = rng.randrange(9)
            if kind == 0:
                core = rng.choice(["commit {v}", "sha1: {v}", "checksum {v}", "rev {v}", "md5 = {v}"]).format(v=hexa(rng.choice([16, 20, 32])))
            elif kind == 1:
                h = hexa(16)
                core = rng.choice(["id {v}", "uuid: {v}", "guid = \"{v}\""]).format(v="-".join([h[:8], h[8:12], h[12:16], h[16:20], h[20:]]))
            elif kind == 2:
                core = f"{rng.randrange(99)}@mail{rng.randrange(10)}.{word()}.com"
            elif kind == 3:
                core = f"http://www.{word()}.org/{word()}/{word()}{rng.randrange(100)}.html"
            elif kind == 4:
                core = f"{rng.choice(names)} = \"{rng.choice(['your-token-here-123', 'xxxxxxxxxxxxxxxx0000', 'example-key-1234567', 'changeme-changeme-1', 'test-test-test-0001', '0000000000000000000'])}\""
            elif kind == 5:
                core = "_".join(word() for _ in range(rng.randint(3, 6))) + f"_{rng.randrange(10)}"
            elif kind == 6:
                core = "".join(word() for _ in range(4)) + str(rng.randrange(100))
            elif kind == 7:
                core = f"{word()}-{rng.randrange(20)}.{rng.randrange(20)}.{rng.randrange(20)}-{word()}.tar.gz"
            else:
                core = pick("0123456789", rng.randint(16, 22))
            path = rng.choice(["docs", "tests/data", "src/app", "web", "examples", "notes", "src1"])
        rows.append((" ".join(rng.sample(filler, 4)) + " " + core + " " + " ".join(rng.sample(filler, 4)), path, label))
    return spark.createDataFrame(rows, "text string, path string, label int").coalesce(1)


def candidates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, path, place (number of the word the value starts in), value, before, after: every candidate of every text."""
    words = rows.where(F.col("text").rlike(CANDIDATE)).select(*keys, "path", F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0)).alias("w"))
    places = F.expr(f"filter(sequence(0, size(w) - 1), i -> w[i] rlike '{CANDIDATE}')")
    near = F.transform(places, lambda i: F.struct(i.alias("place"), _values(F.get(F.col("w"), i)).alias("values"), *_around(i)))
    found = words.select(*keys, "path", F.explode(near).alias("c"))
    found = found.select(*keys, "path", "c.place", "c.before", "c.after", F.explode("c.values").alias("v"))
    found = found.select(*keys, "path", "place", F.concat_ws(" ", "before", "v.lead").alias("before"), "after", "v.value")
    text = F.translate("text", _OPEN + _CLOSE + _HEAD + _END, "\x03" * 4)
    named = _named(rows.where(F.col("text").rlike(ASSIGNED)), keys, F.regexp_replace(text, F.lit(ASSIGNED), F.lit(f"$1{_OPEN}$2{_CLOSE}")))
    hosted = F.regexp_replace(text, F.lit(HOSTED), F.lit(f"{_HEAD}$1{_END}"))
    logins = F.translate(F.regexp_replace(hosted, F.lit(LOGIN), F.lit(f"$1{_OPEN}$2{_CLOSE}")), _HEAD + _END, "")
    login = _named(rows.where(F.col("text").rlike("@[A-Za-z0-9\\[]")), keys, logins)
    return found.unionByName(named).unionByName(login)


def _values(word: Column) -> Column:
    """The runs of key characters in a word, each with what stands between it and the run before."""
    leads = F.transform(F.split(word, CANDIDATE, -1), lambda piece: F.right(piece, F.lit(NEAR)))
    found = F.regexp_extract_all(word, F.lit(CANDIDATE), F.lit(0))
    return F.zip_with(F.slice(leads, F.lit(1), F.size(found)), found, lambda lead, value: F.struct(lead.alias("lead"), value.alias("value")))


def _around(i: Column) -> list[Column]:
    earlier = F.slice("w", F.greatest(i - AROUND, F.lit(0)) + 1, F.least(i, F.lit(AROUND)))
    return [
        F.array_join(F.transform(earlier, lambda w: F.right(w, F.lit(NEAR))), " ").alias("before"),
        F.array_join(F.transform(F.slice("w", i + 2, F.lit(AROUND)), lambda w: F.left(w, F.lit(NEAR))), " ").alias("after"),
    ]


def _named(rows: DataFrame, keys: list[str], marked: Column) -> DataFrame:
    """The candidates that stand between marks in `marked`, but for those that are runs of key characters as
    well. The marks are no blanks: words keep their numbers.

    The text is split at the marks into lead, value, lead, value, ..., rest; the word a value starts in is
    the number of words that start before it, less one if its lead ends inside a word."""
    words = rows.select(*keys, "path", marked.alias("m")).where(F.col("m").contains(_OPEN))
    bare = lambda c: F.translate(c, _OPEN + _CLOSE, "")
    words = words.select(*keys, "path", F.regexp_extract_all("m", F.lit(SPACED_WORD), F.lit(0)).alias("w"), F.split("m", f"[{_OPEN}{_CLOSE}]", -1).alias("pieces"))
    opens = F.expr(f"flatten(transform(sequence(0, size(w) - 1), i -> array_repeat(i, length(w[i]) - length(replace(w[i], '{_OPEN}', '')))))")
    words = words.withColumn("places", opens)
    each = F.transform(F.sequence(F.lit(1), F.size("places")), lambda k: F.struct(
        F.get(F.col("places"), k - 1).alias("place"), F.get(F.col("pieces"), 2 * k - 1).alias("value"),
        F.left(F.get(F.col("pieces"), 2 * k), F.lit(1)).alias("next"),
        F.right(F.element_at(F.split(F.get(F.col("pieces"), 2 * k - 2), "[\\x20\\x09-\\x0D]", -1), -1), F.lit(NEAR)).alias("lead"),
    ))
    near = F.transform(each, lambda c: F.struct(c["place"].alias("place"), c["value"].alias("value"), c["lead"].alias("lead"), c["next"].alias("next"), *_around(c["place"])))
    found = words.select(*keys, "path", F.explode(near).alias("c")).select(*keys, "path", "c.*")
    run = F.col("value").rlike(f"^{CANDIDATE}$") & ~F.col("lead").rlike("[A-Za-z0-9_+/.-]$") & ~F.col("next").rlike("[A-Za-z0-9_+/.=-]")
    found = found.where(~run)
    return found.select(*keys, "path", "place", bare(F.concat_ws(" ", "before", "lead")).alias("before"), bare("after").alias("after"), "value")


FEATURES = ["length", "turns", "digits", "uppers", "lowers", "hexadecimal", "dots", "dashes", "repeats", "covered", "credential", "sample", "other", "assigned", "quoted", "path_sample", "path_config", "own_sample", "marks", "code", "login"]


def described(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Candidates with their features. `texts` is what dictionary counts are taken over, whole."""
    pieces = F.expr("filter(split(lower(value), '[^a-z]+'), p -> length(p) > 2)")
    found = staged(found.withColumn("pieces", pieces), "candidates")
    asked = staged(found.select(F.explode(F.array_distinct("pieces")).alias("piece")).distinct(), "pieces")
    plain = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0))
    counted = texts.select(F.explode(plain).alias("piece")).join(few(asked), "piece").groupBy("piece").count().where(f"count >= {COMMON}")
    known = staged(counted.select("piece", F.lit(1).alias("known")), "dictionary")
    values = found.select("value", F.explode("pieces").alias("piece")).distinct().join(few(known), "piece")
    cover = values.groupBy("value").agg(F.sum(F.length("piece")).alias("covered_letters"))
    n = F.length("value")
    share = lambda kind: F.length(F.regexp_replace("value", f"[^{kind}]+", "")) / n
    flag = lambda c: c.cast("double")
    kinds = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]+", "0"), "[a-z]+", "1"), "[A-Z]+", "2"), "_", "-")
    return found.join(cover, "value", "left").select(
        "*", n.cast("double").alias("length"), (F.length(kinds) / n).alias("turns"), share("0-9").alias("digits"), share("A-Z").alias("uppers"), share("a-z").alias("lowers"),
        flag(F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hexadecimal"), share(".").alias("dots"), share("_/-").alias("dashes"),
        (1 - F.size(F.array_distinct(F.split("value", ""))) / n).alias("repeats"), F.least(F.coalesce("covered_letters", F.lit(0)) / n, F.lit(1.0)).alias("covered"),
        flag(F.col("before").rlike(f"(?i){CREDENTIAL}")).alias("credential"), flag(F.concat_ws(" ", "before", "after").rlike(f"(?i){EXAMPLE}")).alias("sample"),
        flag(F.col("before").rlike(f"(?i)\\b({OTHER})")).alias("other"), flag(F.col("before").rlike("[=:]\\s*[\"']?\\s*$")).alias("assigned"), flag(F.col("before").rlike("[\"']\\s*$")).alias("quoted"),
        flag(F.coalesce("path", F.lit("")).rlike(f"(?i){EXAMPLE}|doc")).alias("path_sample"), flag(F.coalesce("path", F.lit("")).rlike("(?i)conf|deploy|prod|env")).alias("path_config"),
        flag(F.col("value").rlike(f"(?i){EXAMPLE}")).alias("own_sample"),
        share("!@#$%^&*?~").alias("marks"), flag(F.col("value").rlike(r"[(\[{<]|\w\.\w")).alias("code"), flag(F.col("before").rlike(r"://[^\s/:@]*:$")).alias("login"),
    )


def findings(docs: DataFrame, known: DataFrame | None = None, path: str = "source") -> DataFrame:
    """doc_id, place, value, score and is_secret of every candidate of every document.

    `known` are labelled findings (text, path, label); a fixed set by rule if none are given. Null and empty
    texts have no candidates. A value that stands several times is as many findings; repeated rows repeat
    theirs. A null path or id is one without name.
    """
    spark = docs.sparkSession
    known = labelled(spark) if known is None else known
    own = candidates(docs.select("doc_id", "text", F.col(path).cast("string").alias("path")), ["doc_id"]).withColumn("label", F.lit(None).cast("int"))
    taught = candidates(known.select("text", "path", "label"), ["label"]).withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    rows = staged(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described(own.unionByName(taught), docs.select("text"))), "features")
    train = rows.where("label IS NOT NULL").orderBy("value", "before", "after").coalesce(1)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(train)
    judged = forest.transform(rows.where("label IS NULL")).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return judged.select("doc_id", F.col("place").cast("long").alias("place"), "value", "score", (F.col("score") >= ACCEPT).alias("is_secret"))


def masked(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """All documents, with MASK in place of every secret found; n_chars, if there, is counted anew where the
    text changed. Other columns are kept as they are."""
    found = findings(docs, known).where("is_secret").groupBy("doc_id").agg(F.collect_set("value").alias("values"))
    found = staged(found.select(F.col("doc_id").alias("_masked_id"), F.expr("array_sort(values, (a, b) -> length(b) - length(a))").alias("_masked_values")), "secrets")
    joined = docs.join(few(found), docs["doc_id"].eqNullSafe(found["_masked_id"]), "left")
    text = F.expr(f"aggregate(_masked_values, text, (t, v) -> replace(t, v, '{MASK}'))")
    joined = joined.withColumn("text", F.when(F.col("_masked_id").isNotNull() | F.col("_masked_values").isNotNull(), text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("_masked_values").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.select(docs.columns)
