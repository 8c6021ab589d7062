"""Secret scanning with a random forest that removes false positives, in SQL functions only.

Candidates are runs of 16 or more key-like characters with letters and digits, PEM private-key blocks, and what is assigned to a
password or the like, from 8 characters on. The features of one are its length, transitions between character classes, the share of it
that dictionary words cover, signs of a path before it, and the text around it, other candidates included. A run such as NAME=value is two
candidates. The forest is trained on findings that the scan cuts out of labelled texts, which labelled() makes by rule (the kinds of keys
that leak, and the hashes, ids, paths, addresses, names and placeholders that scanners report by mistake), and is then walked by SQL
functions: its nodes are array literals.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, free_name, small_or_shuffled, table

CHARS = "A-Za-z0-9+/=_~.-"
#: A run of 16 characters or more that doesn't continue one, or the body of a private key.
CANDIDATE = rf"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]*PRIVATE KEY-----)?|(?<![{CHARS}])[{CHARS}]{{16,}}+"
#: The name, with its "=", of a candidate whose value would be one by itself.
NAME = rf"^[{CHARS.replace('=', '')}]++=++(?=[{CHARS}]{{16,}}+$)"
#: What a password or the like is set to; PREFIX is all of it before the value.
PREFIX = r"(?i)(?:password|passwd|passphrase|pwd|secret)[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"'`]?"
ASSIGNED = PREFIX + r"[^\s\"'`<>,;]{8,}+"
#: Characters before and after a candidate that features look at.
BEFORE, AFTER = 48, 24
#: Words that names, paths and placeholders are made of.
DICTIONARY = """
access account action address admin alpha api app apple array asset author auto avatar back backup bar base batch beta bin black blog blue
board body book bool box branch browser bucket build bundle button byte cache call card case cert change chapter char chart check child
class client close cloud code color com commit common config content control copy core count create css current custom daily data date
default delete demo deploy detail device dev dist doc document domain down draft edit email end engine entry error event example export
extra feature field file filter final first folder font footer form format forum frame from full func function game get global graph green
group guide handler hash header help hidden home host html http icon image import index info init input install int internal issue item
java job json key label lang large last layer layout lib library license line link list load local lock log login main manager map master
media member menu message meta method mobile mode model module month name net network new news next node note null number object old open
option order org output package page panel parent part pass patch path photo place player plugin point policy port post print private
product profile project prod public query queue random read record red region release remote report request reset resource result return
role root route row rule run sample save scale schema screen script search section select send server service session set setting shared
shop short show side sign site size small source space sql staging start state static status store stream string style sub sum super
support sync system table tag target task team temp template test text theme thread thumb time title token tool top total track tree type
unit update upload url user util valid value vendor version video view web week white widget width window word work world wrap write year
your zip zone
"""
WORDS = "|".join(sorted((w for w in DICTIONARY.split() if len(w) > 2), key=len, reverse=True))
KEYWORDS = r"(?i)(secret|token|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer)\W{0,12}$"
HASHWORDS = r"(?i)(sha\d*|md5|commit|checksum|digest|etag|hash|revision|rev|uuid|guid|trace|session|request|build)\W{0,12}$"
FEATURES = ("length", "digits", "lower_digit", "upper_lower", "symbols", "distinct", "words", "hex", "uuid", "keyword", "hashword", "path", "assigned", "quoted", "known", "pem", "called", "upper", "repeats")
#: Score from which a candidate is a secret.
SECRET = 0.5
FINDINGS, TREES, DEPTH = 4800, 25, 8


def features(c: Column, before: Column, after: Column) -> dict[str, Column]:
    """Feature columns of candidates c with the text before and after them."""
    n = F.length(c)
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    count = lambda p: F.regexp_count(c, F.lit(p))
    out = {
        "length": F.least(n, F.lit(200)),
        "digits": count("[0-9]") / n,
        "lower_digit": count("(?<=[a-z])[0-9]|(?<=[0-9])[a-z]") / n,
        "upper_lower": count("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]") / n,
        "symbols": count("[^A-Za-z0-9]") / n,
        "distinct": F.size(F.array_distinct(F.split(F.substring(c, 1, 64), ""))) / F.least(n, F.lit(64)),
        "words": (n - F.length(F.regexp_replace(F.lower(c), WORDS, ""))) / n,
        "hex": flag(c.rlike("^[0-9a-f]+$")),
        "uuid": flag(c.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")),
        "keyword": flag(before.rlike(KEYWORDS)),
        "hashword": flag(before.rlike(HASHWORDS)),
        "path": flag(before.rlike(r"[/\\:@]$|(?i)(https?|path|file|href|src)\W{0,6}$")) + flag(c.rlike(r"^[./~]|/.*/|\.[a-z]{2,4}$")),
        "assigned": flag(before.rlike(r"[=:]\s*[\"'`]?$")),
        "quoted": flag(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
        "known": flag(c.rlike(r"^(AKIA[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{30,}|sk[-_][A-Za-z0-9_-]{20,}|rk_live_|xox[abprs]-|glpat-|npm_[A-Za-z0-9]{30,}|AIza[A-Za-z0-9_-]{30,}|SG\.[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]+\.)")),
        "pem": flag(c.rlike("^-----BEGIN")),
        "called": flag(c.rlike(r"[(){}\[\]$%*]")),
        "upper": count("[A-Z]") / n,
        "repeats": count(r"(.)(?=\1)") / n,
    }
    return {k: v.cast("double") for k, v in out.items()}


def labelled(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """(candidate, before, after, label): labelled findings made by rule from a running number; half of them are secrets."""
    i = F.col("id")
    sha = lambda k, bits=256: F.sha2(F.concat(i.cast("string"), F.lit(f"/{k}")), bits)
    b64 = lambda k: F.regexp_replace(F.base64(F.unhex(sha(k))), "=+$", "")
    pick = lambda k, *xs: F.element_at(F.array(*map(F.lit, xs)), (F.pmod(F.xxhash64(i, F.lit(k)), F.lit(len(xs))) + 1).cast("int"))
    alnum = lambda k: F.regexp_replace(b64(k), "[+/]", "x")
    hexes = lambda k, n: F.substring(sha(k), 1, n)
    known = DICTIONARY.split()
    word = lambda k: F.element_at(F.lit(known), (F.pmod(F.xxhash64(i, F.lit(f"w{k}")), F.lit(len(known))) + 1).cast("int"))
    # words that are in no dictionary
    odd = lambda k: F.translate(F.substring(sha(f"odd{k}"), F.lit(1), pick(f"n{k}", 5, 7, 9, 12)), "0123456789", "aeiouthlns")
    dash = lambda k: F.concat_ws("-", *(F.substring(sha(k), a, m) for a, m in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    key = pick("key", 'token = "', "api_key: ", 'secret="', "password=", "Authorization: Bearer ", 'access_key = "', "auth_token: '", 'client_secret = "', 'TOKEN = "', "TOKEN=", "the api key ", "GITHUB_ACCESS_TOKEN: ", "AWS_SECRET_ACCESS_KEY=", "export API_KEY=", "DB_PASSWORD=")
    no = pick("no", "commit ", "sha1: ", "checksum=", "md5 ", "see ", "the of and ", "uuid=", "request id ", "etag: ", "build ", "revision ", "was ", "- ", "GIT_COMMIT_SHA=", "BUILD_REVISION: ")
    short = pick("len", 20, 24, 32, 40)
    pw = pick("pw", "password = ", 'password: "', "DB_PASSWORD=", "passwd=", "pwd: ", "secret = '", "passphrase: ", "Password: ")
    # some are long
    mixed = F.repeat(F.translate(F.substring(b64("pw"), F.lit(1), pick("pwlen", 2, 8, 9, 10, 12, 14, 18)), "+/", "!#"), pick("pwtimes", 8, 1, 1, 1, 1, 1, 16))
    secret = [
        (key, hexes("a", 40)), (key, F.substring(alnum("b"), 1, 36)), (key, F.substring(b64("c"), 1, 40)), (key, F.expr("upper(substring(sha2(concat(cast(id AS string), '/d'), 256), 1, 40))")),
        (no, F.concat(F.lit("AKIA"), F.upper(F.substring(alnum("e"), 1, 16)))), (no, F.concat(F.lit("ghp_"), F.substring(alnum("f"), 1, 36))), (key, F.concat(F.lit("sk-"), F.substring(alnum("g"), 1, 40))),
        (pick("k", "key ", "\n", "text "), F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----"), b64("h"), F.lit("-----END RSA PRIVATE KEY-----"))), (key, F.substring(sha("i"), F.lit(1), short)), (key, hexes("j", 32)),
        (pw, mixed), (pw, F.concat(F.initcap(word(5)), hexes("k", 3), pick("mark", "!", "#", "_", "%", "$"), word(6))), (pw, F.concat(odd(1), odd(2), hexes("l", 2))),
        (pick("url", "postgres://admin:", "mongodb://root:", "redis://:"), F.concat(F.substring(alnum("m"), 1, 20), F.lit("@host"))), (key, F.concat_ws(".", F.concat(F.lit("eyJ"), F.substring(alnum("n"), 1, 17)), F.substring(alnum("o"), 1, 30), F.substring(alnum("p"), 1, 30))),
    ]
    false = [
        (no, hexes("a", 40)), (no, F.substring(sha("b"), F.lit(1), short)), (pick("u", "uuid ", "id: ", "token ", "session="), dash("c")), (pick("h", "https://", "http://", "href=", "/"), F.concat_ws("/", F.lit("www.site.com"), word(1), hexes("d", 8), word(2))),
        (no, F.concat(word(1), F.lit("-"), word(2), F.lit("-"), hexes("e", 4))), (key, F.concat(F.lit("example_"), word(3), F.lit("_value1"))), (pick("p", "/", "path: ", "file ", "C:\\"), F.concat(F.lit("usr/lib/"), word(1), F.lit("-"), hexes("f", 3), F.lit("/"), word(2), F.lit(".html"))),
        (no, F.concat_ws(".", word(1), word(2), hexes("g", 2), F.lit("com"))), (no, F.concat(F.lit("2024-01-02T03:04:05."), hexes("h", 4))), (no, F.repeat(F.concat(word(4), F.lit("1=")), 3)),
        (pw, pick("place", "changeme", "your_password_here", "xxxxxxxxxxxx", "********", "${DB_PASSWORD}", "%(password)s", "$PASSWORD_FILE", "undefined", "required", "password", "examplepassword", "placeholder", "redacted")), (pw, F.concat(word(5), pick("dot", ".", "_", "("), word(6), pick("end", "()", ".value", "_name", "[0]"))), (pw, F.concat(word(7), F.lit("-"), word(8), F.lit("-"), word(9))),
        (no, F.concat(F.lit("sha512-"), F.substring(b64("q"), 1, 40), F.lit("=="))), (pick("css", "class=", "div.", "id=", "import "), F.concat_ws("_", odd(3), word(1), hexes("r", 5))),
    ]
    # a range of numbers for each kind: all kinds in one expression would be too much code to compile
    rows = lambda y, k, kinds: spark.range(2 * k + y, n, 2 * len(kinds), 1).select(kinds[k][1].alias("candidate"), kinds[k][0].alias("before"), F.lit(y).alias("label"))
    every = reduce(DataFrame.unionByName, [rows(y, k, kinds) for y, kinds in ((1, secret), (0, false)) for k in range(len(kinds))])
    return every.withColumn("after", F.when(F.col("before").rlike("[\"']$"), F.substring("before", -1, 1)).otherwise(" the"))


def grow(x: np.ndarray, y: np.ndarray, rng, depth: int = DEPTH, least: int = 4):
    """A tree: (feature, threshold, left, right) or the share of label 1; each split tries a random four of the features."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean())
    best = None
    for f in rng.choice(x.shape[1], 4, replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], y[order]
        ones = np.cumsum(t)[:-1]
        n = np.arange(1, len(t))
        ok = (v[1:] > v[:-1]) & (n >= least) & (len(t) - n >= least)
        if not ok.any():
            continue
        a, b = ones / n, (ones[-1] + t[-1] - ones) / (len(t) - n)
        gini = np.where(ok, n * a * (1 - a) + (len(t) - n) * b * (1 - b), np.inf)
        k = int(np.argmin(gini))
        if best is None or gini[k] < best[0]:
            best = (gini[k], int(f), float((v[k] + v[k + 1]) / 2))
    if best is None:
        return float(y.mean())
    left = x[:, best[1]] < best[2]
    return best[1], best[2], grow(x[left], y[left], rng, depth - 1, least), grow(x[~left], y[~left], rng, depth - 1, least)


def forest(x: np.ndarray, y: np.ndarray, seed: int = 11) -> list:
    rng = np.random.default_rng(seed)
    return [grow(x[rows], y[rows], rng) for rows in (rng.integers(0, len(y), len(y)) for _ in range(TREES))]


def flat(trees: list) -> dict[str, list]:
    """Trees as one table of nodes: feature (-1: leaf), threshold, left, right, value; roots has each tree's first node."""
    out: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": [], "roots": []}

    def put(t) -> int:
        k = len(out["feature"])
        row = (-1, 0.0, k, k, t) if isinstance(t, float) else (t[0], t[1], -1, -1, 0.0)
        for name, v in zip(("feature", "threshold", "left", "right", "value"), row):
            out[name].append(v)
        if not isinstance(t, float):
            out["left"][k], out["right"][k] = put(t[2]), put(t[3])
        return k

    for t in trees:
        out["roots"].append(put(t))
    return out


def vote(nodes: dict[str, list], x: Column) -> Column:
    """Mean value of the leaves that the features x (an array in the order of FEATURES) lead to. The trees are array literals, and a
    step down all levels is a fold, so the expression doesn't grow with the forest."""
    lit = {k: F.lit(v) for k, v in nodes.items()}
    step = lambda n, _: F.when(F.get(x, F.greatest(F.get(lit["feature"], n), F.lit(0))) < F.get(lit["threshold"], n), F.get(lit["left"], n)).otherwise(F.get(lit["right"], n))
    leaf = lambda root: F.aggregate(F.lit(list(range(DEPTH))), root, step)
    return F.aggregate(lit["roots"], F.lit(0.0), lambda acc, r: acc + F.get(lit["value"], leaf(r))) / len(nodes["roots"])


#: The forest by the number of findings, once trained: it depends on nothing else.
FORESTS: dict[int, dict[str, list]] = {}


def model(spark: SparkSession) -> dict[str, list]:
    """The forest trained on what the scan cuts out of the texts of labelled(): a secret is what overlaps a planted one."""
    if FINDINGS in FORESTS:
        return FORESTS[FINDINGS]
    texts = labelled(spark).select("label", F.concat("before", "candidate", "after").alias("text"), F.length("before").alias("a"), (F.length("before") + F.length("candidate")).alias("z"))
    # written, so that the scan is compiled once and not for each kind
    found = cut(Scratch(spark).save(texts, "labelled"), "label", "a", "z")
    label = F.when((F.col("start") < F.col("z")) & (F.col("start") + F.length("candidate") > F.col("a")), F.col("label")).otherwise(0).alias("label")
    rows = found.select(label, *(v.alias(k) for k, v in features(F.col("candidate"), F.col("before"), F.col("after")).items())).orderBy("label", *FEATURES).collect()
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    FORESTS[FINDINGS] = flat(forest(x, np.array([r.label for r in rows])))
    return FORESTS[FINDINGS]


#: Characters of a block by which pieces of a text are found.
BLOCK = 512


def let(value: Column, f) -> Column:
    """f(value), with value computed once wherever f uses it, within lambdas too."""
    return F.get(F.transform(F.array(value), f), 0)


def running(values: Column, f) -> Column:
    """f over each value and all before it, in as many passes as the number of values has bits: appending one by one would copy all each time."""
    step = lambda j: F.call_function("shiftleft", F.lit(1), j)
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))
    return F.aggregate(passes, values, lambda acc, j: F.transform(acc, lambda x, i: F.when(i >= step(j), f(x, F.get(acc, i - step(j)))).otherwise(x)))


def blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def piece(blocks: Column, start: Column, end: Column) -> Column:
    """Characters from start to end of a text: only the blocks in between are looked at, not all of the text before them."""
    at = F.floor(start / BLOCK).cast("int")
    some = F.array_join(F.slice(blocks, at + 1, F.floor(end / BLOCK).cast("int") - at + 1), "")
    return F.substring(some, start - at * BLOCK + 1, end - start)


def matches(texts: DataFrame, pattern: str, *keep: str) -> DataFrame:
    """(*keep, c, start, before, after) of every match in the column text of every row."""
    found = texts.where(F.col("text").rlike(pattern)).select(*keep, "text", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("c"), F.split("text", pattern, -1).alias("s"))
    n = F.size("c")
    ends = running(F.zip_with(F.slice("s", F.lit(1), n), "c", lambda s, c: F.length(s) + F.length(c)), lambda x, y: x + y)
    starts = F.zip_with(ends, "c", lambda e, c: e - F.length(c))
    first = let(blocks(F.col("text")), lambda b: F.transform(starts, lambda x: F.struct(x.alias("start"), piece(b, F.greatest(x - BEFORE, F.lit(0)), x).alias("before"))))
    # the text after a match, with the next one: together more than AFTER, or up to the one that follows
    after = F.zip_with(F.slice("s", F.lit(2), n), F.slice(F.array_append("c", F.lit("")), F.lit(2), n), lambda s, c: F.left(F.concat(s, c), F.lit(AFTER)))
    each = found.select(*keep, F.explode(F.arrays_zip(F.col("c").alias("c"), first.alias("f"), after.alias("after"))).alias("x"))
    return each.select(*keep, "x.c", "x.f.start", "x.f.before", "x.after")


def cut(texts: DataFrame, *keep: str) -> DataFrame:
    """(*keep, start, candidate, before, after) of every candidate in the column text of every row."""
    part = lambda start, candidate, before, after: F.struct(start.alias("start"), candidate.alias("candidate"), F.right(before, F.lit(BEFORE)).alias("before"), F.left(after, F.lit(AFTER)).alias("after"))
    out = ("start", "candidate", "before", "after")
    rest = lambda n: F.substring("c", n + 1, F.length("c"))
    bare = F.rtrim(F.col("name"), F.lit("="))
    parts = F.array(
        part(F.col("start"), bare, F.col("before"), F.concat(rest(F.length(bare)), "after")),
        part(F.col("start") + F.length("name"), rest(F.length("name")), F.concat("before", "name"), F.col("after")))
    runs = matches(texts, CANDIDATE, *keep).withColumn("name", F.regexp_extract("c", NAME, 0)).select(*keep, F.explode(parts).alias("x")).select(*keep, "x.*")
    # values without a name are whole; names are candidates if they are as long as one
    runs = runs.where((F.length("candidate") >= 16) & F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")).select(*keep, *out)
    # passwords: those that are a run are left to it
    name = F.regexp_extract("c", "^" + PREFIX, 0)
    words = matches(texts, ASSIGNED, *keep).withColumn("name", name).select(*keep, (F.col("start") + F.length("name")).alias("start"), rest(F.length("name")).alias("candidate"), F.right(F.concat("before", "name"), F.lit(BEFORE)).alias("before"), "after")
    return runs.unionByName(words.where(~F.col("candidate").rlike(f"^(?=.*[0-9])(?=.*[A-Za-z])[{CHARS}]{{16,}}$")).select(*keep, *out))


def scan(docs: DataFrame, nodes: dict[str, list] | None = None) -> DataFrame:
    """(doc_id, start, end, candidate, score, is_secret): every candidate of every text; start and end count characters, end exclusive.

    A password within a run such as NAME_1=pass is found both ways. Null and empty texts have none, nor does an empty table. Repeated rows
    give repeated findings; doc_id may be null; other columns are ignored, whatever their names. What is neither a run of 16 characters
    with letters and digits nor assigned to a name of PREFIX is no candidate; candidates may be of any length and any number.
    """
    nodes = nodes or model(docs.sparkSession)
    each = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    x = F.array(*features(F.col("candidate"), F.col("before"), F.col("after")).values())
    scored = each.select("doc_id", "start", "candidate", x.alias("x")).withColumn("score", vote(nodes, F.col("x")))
    return scored.select("doc_id", "start", (F.col("start") + F.length("candidate")).alias("end"), "candidate", F.round("score", 6).alias("score"), (F.round("score", 6) >= SECRET).alias("is_secret"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret replaced by `mark`, and n_chars (if there is one) to match; all rows and columns stay.

    Null texts stay null; repeated rows are each cleaned; an empty table stays empty.
    """
    keep = Scratch(docs.sparkSession)
    h, spans = free_name(docs, "h"), free_name(docs, "spans")
    # spans belong to a text, whichever rows have it
    found = scan(docs.select(F.xxhash64("text").alias("doc_id"), "text")).where("is_secret").select(F.col("doc_id").alias(h), F.struct("start", "end").alias("span"))
    each = keep.save(found.groupBy(h).agg(F.sort_array(F.collect_set("span")).alias(spans)), "spans")
    joined = docs.join(small_or_shuffled(each, 10 * each.count()), F.xxhash64("text") == F.col(h), "left")
    # of findings that overlap, each adds what it has beyond those before it
    reach = running(F.transform(spans, lambda x: x["end"]), F.greatest)
    before = lambda r, i: F.when(i > 0, F.get(r, i - 1)).otherwise(0)
    some = lambda b, r: F.transform(spans, lambda x, i: F.when(x["start"] >= before(r, i), F.concat(piece(b, before(r, i), x["start"]), F.lit(mark))).otherwise(""))
    clean = let(blocks(F.col("text")), lambda b: let(reach, lambda r: F.array_join(F.array_append(some(b, r), piece(b, F.element_at(r, -1), F.length("text"))), "")))
    out = joined.withColumn("text", F.when(F.col(spans).isNotNull(), clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
