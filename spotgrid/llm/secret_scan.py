"""Secret scan by multipart credential linking, in Spark expressions.

Patterns find the parts of credentials in every text. Labelled secrets, access keys and long hex strings stand on their
own. Three weaker kinds (account names, opaque strings, endpoints) are common in harmless text, so they are reported
only where complementary parts stand near each other:

* an opaque string or a labelled account name needs its counterpart (an identifier or a secret) within ``REACH``;
* an endpoint needs both an identifier and a secret within ``REACH``.

A complement stands beside a part, before or after it; one that overlaps it is no second part. "Near" is an interval
join within scopes of ``REACH`` code points of a document: a part's end lies in its own scope and the next one, and a
candidate looks up the last end before it in its own scope, by a running maximum; starts after it likewise, on mirrored
places. That is at most six rows a part and exact, however many parts a scope holds.

Defined cases: null text is empty and has no span; empty and very long texts are scanned whole; a row's result depends
on its id and text alone, and repeated rows give repeated results, as many as there are rows; other columns are ignored,
and kept by the redaction, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotgrid.llm.arrays import bind
from spotgrid.sources.shared import stage

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
_ACCOUNT = r"(?:[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Uu][Ss][Ee][Rr](?:_?[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt])"
#: (kind, pattern, role). The order is the order of kinds that start at one place. An opaque string may follow '=' (KEY=value), but not the '=' of
#: an account label, whose value is the account's name; or the '.' of a dotted token (SG.xxx.yyy), unless it goes on like a path (example.com/...).
KINDS = (
    ("assign", r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
     + _VALUE + r"([A-Za-z0-9+/_.=-]+)", "secret"),
    ("access", r"AKIA[A-Z0-9]{16,}", "identifier"),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", "secret"),
    ("account", r"(?<![A-Za-z0-9])" + _ACCOUNT + _VALUE + r"([A-Za-z0-9@._-]{3,}+)(?!://)", "identifier"),
    ("opaque", r"(?:(?<![A-Za-z0-9+/_.-])(?<!" + _ACCOUNT + r"=)|(?<=[A-Za-z0-9_-]\.)(?![a-z0-9]{1,24}/))"
     r"(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}", "secret"),
    ("endpoint", r"(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|redis|amqp)://[A-Za-z0-9][A-Za-z0-9.:/?&=%@_-]{3,}", "endpoint"),
)
BASE = ("assign", "access", "hex")
LEAST_ASSIGNED = 6
REACH = 200
#: Spans are sent to all tasks for at most so many documents; beyond, the join shuffles.
BROADCAST_DOCUMENTS = 200_000
_ORDER = {kind: i for i, (kind, _, _) in enumerate(KINDS)}


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Matches of one pattern: array of (kind order, at, gap since the last match and length, both in code points and in bytes, whether it counts)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.arrays_zip(hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"))
    counts = (lambda hit: F.length(F.regexp_extract(hit, pattern, 1)) >= LEAST_ASSIGNED) if kind == "assign" else (lambda hit: F.lit(True))
    rows = F.transform(both, lambda x, i: F.struct(
        F.lit(_ORDER[kind]).alias("kind"), i.alias("at"), F.length(x["gap"]).cast("long").alias("gap"), F.length(x["hit"]).cast("long").alias("length"),
        F.octet_length(x["gap"]).cast("long").alias("byte_gap"), F.octet_length(x["hit"]).cast("long").alias("bytes"), counts(x["hit"]).alias("counts")))
    return F.when(F.regexp_like(text, F.lit(pattern)), rows)


def print_of(text: Column) -> Column:
    """Tells texts of one id apart."""
    body = F.coalesce(text, F.lit(""))
    return F.xxhash64(body, F.length(body))


def parts(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, parts): (key, print) of every row, and its parts as (key, print, kind, start, stop, byte_start, byte_stop), each once."""
    tagged = docs.select(F.col(key).alias("key"), print_of(F.col(text)).alias("print"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    found = F.concat(*[F.coalesce(_found(F.col("body"), k, p), F.array().cast("array<struct<kind:int,at:int,gap:bigint,length:bigint,byte_gap:bigint,bytes:bigint,counts:boolean>>")) for k, p, _ in KINDS])
    hits = tagged.select("key", "print", F.explode(found).alias("hit")).select("key", "print", "hit.*")
    # One exchange by document serves all that follows: taking out repeated rows, places, scopes and digests.
    hits = hits.repartition("key", "print").dropDuplicates(["key", "print", "kind", "at"])
    upto = Window.partitionBy("key", "print", "kind").orderBy("at")
    ends = hits.withColumns({"stop": F.sum(F.col("gap") + F.col("length")).over(upto), "byte_stop": F.sum(F.col("byte_gap") + F.col("bytes")).over(upto)})
    placed = ends.where("counts").select(
        "key", "print", "kind", (F.col("stop") - F.col("length")).alias("start"), "stop", (F.col("byte_stop") - F.col("bytes")).alias("byte_start"), "byte_stop")
    # Three steps read the parts; the texts are scanned once.
    return tagged.select("key", "print"), stage(docs.sparkSession, placed, "secret_parts")


SPAN = ("kind", "start", "stop", "byte_start", "byte_stop")


def link(placed: DataFrame, reach: int = REACH) -> DataFrame:
    """Keep base parts, and weak ones whose complementary parts stand within reach, before or after them."""
    role = F.element_at(F.array(*[F.lit(r) for _, _, r in KINDS]), F.col("kind") + 1)
    mirrored = F.col("side") == 1
    sides = placed.withColumn("role", role).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns({
        "end": F.when(mirrored, -F.col("start")).otherwise(F.col("stop")), "ask": F.when(mirrored, -F.col("stop")).otherwise(F.col("start"))})
    scope = lambda c: F.floor(F.col(c) / reach)
    of = lambda r: F.when(F.col("role") == r, F.col("end")).alias(f"last_{r}")
    ends = sides.where("role != 'endpoint'").select(
        "key", "print", "side", F.explode(F.array(scope("end"), scope("end") + 1)).alias("scope"), F.col("end").alias("at"), F.lit(0).alias("asks"), of("identifier"), of("secret"))
    asks = sides.where(F.col("kind") >= len(BASE)).select("key", "print", "side", scope("ask").alias("scope"), F.col("ask").alias("at"), F.lit(1).alias("asks"), "role", *SPAN)
    upto = Window.partitionBy("key", "print", "side", "scope").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    near = lambda r: F.coalesce(F.max(f"last_{r}").over(upto) > F.col("at") - reach, F.lit(False))
    met = ends.unionByName(asks, allowMissingColumns=True).withColumns({"near_id": near("identifier"), "near_secret": near("secret")}).where("asks = 1")
    flags = met.groupBy("key", "print", "role", *SPAN).agg(F.max("near_id").alias("near_id"), F.max("near_secret").alias("near_secret"))
    kept = flags.where(F.when(F.col("role") == "secret", F.col("near_id")).when(F.col("role") == "identifier", F.col("near_secret")).otherwise(
        F.col("near_id") & F.col("near_secret")))
    return placed.where(F.col("kind") < len(BASE)).select("key", "print", *SPAN).unionByName(kept.select("key", "print", *SPAN))


def merged(linked: DataFrame) -> DataFrame:
    """(key, print, byte_start, byte_stop) of the runs of spans that overlap or touch."""
    order = Window.partitionBy("key", "print").orderBy("byte_start", "byte_stop")
    before = F.max("byte_stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("byte_start") > F.coalesce(before, F.lit(-1)), 1).otherwise(0)
    runs = linked.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("key", "print", "run").agg(F.min("byte_start").alias("byte_start"), F.max("byte_stop").alias("byte_stop")).drop("run")


def _spans(linked: DataFrame) -> DataFrame:
    return linked.select("key", "print", F.struct("start", F.col("kind").cast("int").alias("kind"), "stop").alias("span"))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: key and spans, its reported spans as a sorted array of (start, kind, stop); kind is an index of KINDS."""
    rows, placed = parts(docs, key, text)
    none = F.lit(None).cast("struct<start:bigint,kind:int,stop:bigint>")
    every = rows.select("key", "print", F.lit(1).alias("row"), none.alias("span")).unionByName(
        _spans(link(placed, reach)).select("key", "print", F.lit(0).alias("row"), "span"))
    grouped = every.groupBy("key", "print").agg(F.sum("row").alias("rows"), F.array_sort(F.collect_list("span")).alias("spans"))
    # Repeated rows were counted; give each its result back.
    return grouped.select(F.col("key").alias(key), "print", "spans", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_")).drop("_")


def redact_secrets(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """All documents with all their columns; every reported span of the text is replaced by ``[secret]``."""
    _, placed = parts(docs, key, text)
    cuts = F.array_sort(F.collect_list(F.struct("byte_start", "byte_stop"))).alias("cuts")
    found = stage(spark, merged(link(placed, reach)).groupBy("key", "print").agg(cuts), "secret_spans")
    if found.limit(BROADCAST_DOCUMENTS + 1).count() <= BROADCAST_DOCUMENTS:
        found = F.broadcast(found)
    rows = docs.select(F.struct("*").alias("row"))
    field = lambda c: F.col("row").getField(c)
    same = field(key).eqNullSafe(F.col("key")) & (print_of(field(text)) == F.col("print"))
    return rows.join(found, same, "left").select(*[(redact(field(c), F.col("cuts")) if c == text else field(c)).alias(c) for c in docs.columns])


def listed(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end of the spans, comma-joined."""
    name = F.array(*[F.lit(k) for k, _, _ in KINDS])
    chosen = F.filter(spans, lambda s: s["kind"] < len(BASE)) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["stop"])), ",")


def redact(text: Column, cuts: Column) -> Column:
    """The text with ``[secret]`` in place of every cut (byte_start, byte_stop); cuts are sorted and lie apart. Unchanged without cuts."""
    def pieces(data: Column) -> Column:
        upto = lambda i: F.coalesce(F.get(cuts, i - 1)["byte_stop"], F.lit(0))
        part = lambda start, size: F.substr(data, (start + 1).cast("int"), size.cast("int")).cast("string")
        before = F.transform(cuts, lambda c, i: F.concat(part(upto(i), c["byte_start"] - upto(i)), F.lit("[secret]")))
        last = F.element_at(cuts, -1)["byte_stop"]
        return F.concat(before, F.array(part(last, F.octet_length(data) - last)))

    return F.when(F.size(cuts) > 0, F.array_join(bind(text.cast("binary"), pieces), "")).otherwise(text)
