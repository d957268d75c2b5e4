"""Secret scans with multipart credential linking, in DataFrame expressions only.

Strong findings (assignments, access keys, long hexadecimal strings) stand by themselves.
Weak candidates (user names or account ids, short secrets, endpoints, long mixed strings
without a key word) are reported only where complementary parts meet: an access identifier opens a scope of ``scope`` code
points on either side, and an interval join brings to it the secrets and endpoints that
begin inside.  A weak identifier or secret needs the other part in the scope; an endpoint
needs both.

Places come from cutting a text at its matches: the lengths of what lies between and of the
matches themselves, summed up, give code-point offsets, row by row and without a shuffle.
Only texts that hold weak parts take part in the join, as spans, never as text; its key is
the document and its place range, so a very long text spreads over many keys.

Defined cases: a null text is empty; rows that repeat (same id and text) get the same
answer; a null id is an id; other columns pass through ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import kept

#: Strong kinds: pattern and least length (of group 1 for assign, of the match for others), listed in order of report.
#: The look-ahead only saves time.
BASE = {
    "assign": (r"""(?=[PpSsTtAa])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
#: Where a key word begins: after no letter or digit (so after the _ of DB_USER), or at a capital inside a name (dbUser, DBUser).
_NAME = "(?:(?<![A-Za-z0-9])|(?<=[a-z0-9])(?=[A-Z])|(?=[A-Z][a-z]))"
_RUN = "A-Za-z0-9+/_-"
#: Weak kinds: pattern and role.  A span begins at the key word, as those of assign do, not at the name's earlier parts.
WEAK = {
    "login": (_NAME + r"""(?i:(?:pg)?user_?name|user_?id|(?:pg)?user|login|account_?id|account_?name|account|client_?id|access_?key_?id|access_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", "id"),
    "pass": (_NAME + r"""(?i:pwd|pass|passphrase|password|passwd|secret|token|api_?key|credential|secret_?key|secret_?access_?key|auth_?key|private_?key|access_?key|account_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=!@#%-]{4,}""", "secret"),
    "endpoint": (_NAME + r"""(?i:(?:https?|ftp|ssh|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+|(?:(?:pg)?host|host_?name|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,})""", "endpoint"),
    # no key word: a run of 32 characters or more with a small letter, a capital and a digit
    "bare": (rf"(?<![A-Za-z0-9+/])(?!//)(?=[{_RUN}]{{32}})(?=[A-Z0-9+/_-]*[a-z])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Za-z+/_-]*[0-9])[{_RUN}]+={{0,2}}", "secret"),
}
ROLE = {"assign": "secret", "access": "id", "hex": "secret"} | {k: role for k, (_, role) in WEAK.items()}
ORDER = {k: i for i, k in enumerate([*BASE, *WEAK])}
SCOPE = 200
SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running(steps: Column, plus) -> Column:
    """plus over all entries up to and with each.  Blocks of about the square root of the length keep the cost at n**1.5 copies."""

    def grow(xs: Column) -> Column:
        more = lambda acc, x: let(F.when(F.size(acc) == 0, x).otherwise(plus(F.element_at(acc, -1), x)).cast("int"), lambda y: F.concat(acc, F.array(y)))
        return F.aggregate(xs, F.array().cast("array<int>"), more)

    def blocks(xs: Column) -> Column:
        size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs))).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(xs) - 1), size), lambda s: F.slice(xs, s + 1, size))

    def total(own: Column) -> Column:
        # own: each block's running values; the last one of each, run over blocks, goes into the next block's
        return let(grow(F.transform(own, lambda g: F.element_at(g, -1))), lambda upto: F.flatten(F.transform(own, lambda g, i: F.when(i == 0, g).otherwise(F.transform(g, lambda x: plus(upto[i - 1], x))))))

    made = let(blocks(steps), lambda parts: let(F.transform(parts, grow), total))
    return F.when(F.size(steps) == 0, F.array().cast("array<int>")).otherwise(made)


def running_sum(steps: Column) -> Column:
    """Sums up to and with each entry."""
    return let(steps, lambda xs: running(xs, lambda a, b: a + b))


def _found(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """The kind's spans: leftmost matches that don't overlap, without those that are too short."""
    p = F.lit(pattern)
    parts = F.struct(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(F.regexp_extract_all(text, p, 0), lambda x: F.length(x)).alias("hit"),
        F.transform(F.regexp_extract_all(text, p, group), lambda x: F.length(x)).alias("own"),
    )

    def spans(x: Column) -> Column:
        # from each match's end to the next one's: what lies between, and the match
        ends = running_sum(F.transform(x["hit"], lambda h, i: h + x["gap"][i]))
        made = F.transform(ends, lambda e, i: F.struct((e - x["hit"][i]).alias("start"), F.lit(ORDER[kind]).alias("rank"), e.alias("end"), F.lit(kind).alias("kind"), x["own"][i].alias("own")))
        return F.transform(F.filter(made, lambda s: s["own"] >= least), lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))

    return F.when(text.rlike(pattern), let(parts, spans)).otherwise(F.array().cast(f"array<{SPAN}>")).cast(f"array<{SPAN}>")


def _apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others.

    In the order of starts a span overlaps one that comes before it if the furthest end so far is beyond its
    start, and one that comes after it if the next start of one is before its end."""
    far = (1 << 31) - 1
    own = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("mine"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind")))
    other = F.transform(others, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("mine"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind")))

    def met(every: Column) -> Column:
        ends = running(F.transform(every, lambda s: F.when(s["mine"] == 0, s["end"]).otherwise(0)), F.greatest)
        starts = F.reverse(running(F.reverse(F.transform(every, lambda s: F.when(s["mine"] == 0, s["start"]).otherwise(far))), F.least))
        places = F.struct(ends.alias("ends"), starts.alias("starts"))
        free = lambda x: F.filter(F.transform(every, lambda s, i: F.struct(s.alias("s"), ((s["mine"] == 1) & (x["ends"][i] <= s["start"]) & (x["starts"][i] >= s["end"])).alias("free"))), lambda y: y["free"])
        return let(places, lambda x: F.transform(free(x), lambda y: F.struct(y["s"]["start"], y["s"]["rank"], y["s"]["end"], y["s"]["kind"])))

    return F.when((F.size(spans) > 0) & (F.size(others) > 0), let(F.array_sort(F.concat(own, other)), met).cast(f"array<{SPAN}>")).otherwise(spans)


def _weak(base: Column, found: Column) -> Column:
    """Weak spans that don't overlap a strong one; bare ones overlap no other weak one either."""
    named = F.filter(found, lambda s: s["kind"] != "bare")
    bare = F.filter(found, lambda s: s["kind"] == "bare")
    return F.when(F.size(found) > 0, F.concat(_apart(named, base), _apart(_apart(bare, base), named))).otherwise(found)


_KEY = ["__id", "__hash", "__length"]


def _spans(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """Per row: its key, the strong spans and the weak candidates."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column).alias("__id"), F.xxhash64(t).alias("__hash"), F.length(t).alias("__length"), t.alias("__text"))
    none = F.array().cast(f"array<{SPAN}>")
    rows = rows.select(
        *_KEY,
        F.concat(*(_found(F.col("__text"), k, p, g, least) for k, (p, g, least) in BASE.items())).alias("base"),
        F.when(F.col("__text").rlike("[:=]|AKIA"), F.concat(*(_found(F.col("__text"), k, p, 0, 1) for k, (p, _) in WEAK.items()))).otherwise(none).alias("maybe"),
    )
    return rows.select(*_KEY, "base", _weak(F.col("base"), F.col("maybe")).alias("weak"))


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """Per key with any: the weak spans whose complementary parts are in an access identifier's scope."""
    # a text without both an identifier and a secret links nothing
    role = F.create_map(*(F.lit(x) for kv in ROLE.items() for x in kv))
    every = F.concat("base", "weak")
    has = lambda r: F.exists(every, lambda s: role[s["kind"]] == r)
    some = spans.where((F.size("weak") > 0) & has("id") & has("secret")).select(*_KEY, F.explode(every).alias("s")).distinct()
    parts = some.select(*_KEY, "s", role[F.col("s.kind")].alias("role"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    bucket = lambda c: F.floor(c / F.lit(2 * scope)).cast("long")
    ids = parts.where("role = 'id'").select(*(F.col(k).alias(f"i{k}") for k in _KEY), F.col("s").alias("id"), (F.col("start") - scope).alias("low"), (F.col("end") + scope).alias("high"))
    ids = ids.select("*", F.explode(F.sequence(bucket(F.col("low")), bucket(F.col("high")))).alias("ibucket"))
    others = parts.where("role <> 'id'").withColumn("bucket", bucket(F.col("start")))
    same = F.col("__id").eqNullSafe(F.col("i__id")) & (F.col("__hash") == F.col("i__hash")) & (F.col("__length") == F.col("i__length"))
    met = others.join(ids, same & (F.col("bucket") == F.col("ibucket")) & F.col("start").between(F.col("low"), F.col("high")))
    # per scope: its identifier counts once a secret is there, and so do its endpoints
    scopes = met.groupBy(*_KEY, "id").agg(F.collect_set(F.when(F.col("role") == "secret", F.col("s"))).alias("secrets"), F.collect_set(F.when(F.col("role") == "endpoint", F.col("s"))).alias("endpoints"))
    full = scopes.where(F.size("secrets") > 0).select(*_KEY, F.explode(F.concat(F.array("id"), "secrets", "endpoints")).alias("s"))
    weak = full.where(F.col("s.rank") >= len(BASE))
    return weak.groupBy(*_KEY).agg(F.collect_set("s").alias("more"))


def _with_linked(rows: DataFrame, spans: DataFrame, scope: int) -> DataFrame:
    """The rows (with the key's columns) and their linked weak spans; most texts have none."""
    linked = kept(_linked(spans, scope), "linked").select(*(F.col(k).alias(f"l{k}") for k in _KEY), "more")
    same = F.col("__id").eqNullSafe(F.col("l__id")) & (F.col("__hash") == F.col("l__hash")) & (F.col("__length") == F.col("l__length"))
    return rows.join(linked, same, "left").drop(*(f"l{k}" for k in _KEY)).withColumn("more", F.coalesce("more", F.array().cast(f"array<{SPAN}>")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, *, scope: int = SCOPE, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: its id, n_assign, n_access, n_hex, base_sha256 and spans (all of them, linked weak ones included)."""
    spans = kept(_spans(docs, text, id_column), "spans")
    rows = _with_linked(spans, spans, scope)
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(F.col("__id").alias(id_column), *(n(k) for k in BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "more")).alias("spans"))


#: Code points of the pieces that a text is cut into, so that a place is found without reading from the text's start.
PIECE = 1024


def _replaced(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark for each run of spans (in order of start) that touch or overlap."""

    def gaps(ends: Column) -> Column:
        # what lies before each run, and after the last
        before = F.transform(spans, lambda s, i: F.struct(F.when(i == 0, 0).otherwise(ends[i - 1]).alias("low"), s["start"].alias("high"), (i == 0).alias("first")))
        return F.concat(F.filter(before, lambda g: g["first"] | (g["high"] > g["low"])), F.array(F.struct(F.element_at(ends, -1).alias("low"), F.length(text).alias("high"), F.lit(False).alias("first"))))

    def built(x: Column) -> Column:
        def cut(g: Column) -> Column:
            a, b = F.floor(g["low"] / PIECE).cast("int"), F.floor(g["high"] / PIECE).cast("int")
            head, tail = F.substring(x["pieces"][a], g["low"] % PIECE + 1, F.lit(PIECE)), F.substring(x["pieces"][b], F.lit(1), g["high"] % PIECE)
            inner = F.substring(x["pieces"][a], g["low"] % PIECE + 1, g["high"] - g["low"])
            return F.when(g["high"] <= g["low"], F.lit("")).when(a == b, inner).otherwise(F.concat(head, F.array_join(F.slice(x["pieces"], a + 2, b - a - 1), ""), tail))

        return F.array_join(F.transform(x["gaps"], cut), mark)

    # one piece more than the text has, which is empty: a gap may end where the text does
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / PIECE).cast("int")), lambda i: F.substring(text, i * PIECE + 1, F.lit(PIECE)))
    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return let(F.struct(let(ends, gaps).alias("gaps"), pieces.alias("pieces")), built)


def redact(docs: DataFrame, *, mark: str = "[REDACTED]", scope: int = SCOPE, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The documents with every span, strong or linked, replaced by the mark; a null text stays null.

    Spans that touch or overlap become one mark."""
    t = F.coalesce(F.col(text), F.lit(""))
    spans = kept(_spans(docs, text, id_column), "spans")
    hit = spans.where((F.size("base") > 0) | (F.size("weak") > 0))
    keyed = docs.select("*", F.col(id_column).alias("__id"), F.xxhash64(t).alias("__hash"), F.length(t).alias("__length"))
    linked = _with_linked(hit.dropDuplicates(_KEY), spans, scope).select(*(F.col(k).alias(f"r{k}") for k in _KEY), F.array_sort(F.concat("base", "more")).alias("__spans"))
    linked = kept(linked.where(F.size("__spans") > 0), "redactions")
    same = F.col("__id").eqNullSafe(F.col("r__id")) & (F.col("__hash") == F.col("r__hash")) & (F.col("__length") == F.col("r__length"))
    rows = keyed.join(linked, same, "left")
    built = _replaced(F.col(text), F.col("__spans"), mark)
    new = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(built)
    return rows.select(*(new.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns))
