"""Secret scans that link the parts of multipart credentials (native expressions only).

Candidates. Three base kinds are secrets by themselves (``assign``, ``access``,
``hex``). Three weak kinds say little alone: ``login`` (an account name given
to a keyword), ``endpoint`` (a URL or IPv4 address) and ``opaque`` (a token of
letters and digits). Access keys and logins identify; assignments, hex strings
and opaque tokens are secret parts.

Linking. Every part is an interval in its document, its scope the ``reach``
characters around its start. Weak parts are joined with the complementary parts
of their scope: a login needs a secret part, an opaque token an identifying
part, an endpoint both. The interval join runs on (document, start // reach):
each weak part looks into three bins, each bin holds only the least and largest
start of either role, which decides exactly whether one lies within reach. So
a document with very many parts costs bins, not pairs.

Positions come from splitting a text at the matches and summing the lengths of
gaps and matches, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.llm.common import column, stage, with_row_id

REACH = 200

# The base patterns. Runs of hex digits and of key characters are
# matched greedily from their start, so demanding the length in the pattern
# finds the same spans as dropping short matches; for assignments it does not.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_MIN = 6

LOGIN = r"""(?i)(?:user(?:_?name)?|login|client_?id|account(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
ENDPOINT = (r"""https?://[^\s"'<>|,;]+|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9.])""")
OPAQUE = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}")

KINDS = ["assign", "access", "hex", "login", "endpoint", "opaque"]
BASE, IDENT, SECRET = (0, 1, 2), (1, 3), (0, 2, 5)


def _matches(text: Column, kind: int, pattern: str, when: Column, group: int | None = None, least: int = 0) -> Column:
    """array<struct<kind, gap, len, ok>>: each match, the length of the gap before it, whether it counts."""
    p = F.lit(pattern)
    parts = [F.regexp_extract_all(text, p, F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g")]
    if group is not None:
        parts.append(F.regexp_extract_all(text, p, F.lit(group)).alias("v"))
    # zipped, so that each of them is worked out once per text
    zipped = F.filter(F.arrays_zip(*parts), lambda x: x["m"].isNotNull())
    found = F.transform(zipped, lambda x: F.struct(
        F.lit(kind).alias("kind"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"),
        (F.length(x["v"]) >= least if group is not None else F.lit(True)).alias("ok")))
    return F.when(when, found).otherwise(F.array().cast("array<struct<kind:int,gap:int,len:int,ok:boolean>>"))


def candidates(docs: DataFrame) -> DataFrame:
    """_rid, doc_id, found (array of matches of all kinds) per row. Cheap substring tests spare most texts
    the patterns; weak kinds are looked for only where an identifying part can be."""
    text = F.col("text")
    low = F.lower(text)
    keyed = F.lit(False)
    for word in ("passw", "secret", "token", "apikey", "api_key"):
        keyed = keyed | F.contains(low, F.lit(word))
    named = F.lit(False)
    for word in ("user", "login", "client", "account"):
        named = named | F.contains(low, F.lit(word))
    access = F.contains(text, F.lit("AKIA"))
    rows = with_row_id(docs).select("_rid", column(docs, "doc_id", "long").alias("doc_id"),
                                    F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    some_id = access | (named & F.rlike(text, F.lit(LOGIN)))
    return rows.select("_rid", "doc_id", F.concat(
        _matches(text, 0, ASSIGN, keyed, 2, ASSIGN_MIN), _matches(text, 1, ACCESS, access),
        _matches(text, 2, HEX, F.rlike(text, F.lit(HEX))), _matches(text, 3, LOGIN, named),
        _matches(text, 4, ENDPOINT, some_id), _matches(text, 5, OPAQUE, some_id)).alias("found"))


def _without_overlap(spans: DataFrame, holder: Column, victim: Column) -> DataFrame:
    """Drop victims that overlap a holder of the same document."""
    line = Window.partitionBy("_rid").orderBy("start", "kind")
    last = F.max(F.when(holder, F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.min(F.when(holder, F.col("start"))).over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (spans.withColumn("_l", last).withColumn("_f", following)
            .filter(~victim | (F.coalesce(F.col("_l") <= F.col("start"), F.lit(True))
                               & F.coalesce(F.col("_f") >= F.col("end"), F.lit(True)))).drop("_l", "_f"))


def spans(found: DataFrame) -> DataFrame:
    """(_rid, kind, start, end) of all candidates that count, weak ones only where nothing stronger lies."""
    rows = (found.filter(F.size("found") > 0).select("_rid", F.posexplode("found").alias("i", "m"))
            .select("_rid", "i", "m.*").repartition("_rid"))
    line = Window.partitionBy("_rid", "kind").orderBy("i")
    done = F.coalesce(F.sum("len").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gaps = F.sum("gap").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.withColumn("start", (gaps + done).cast("long")).withColumn("end", F.col("start") + F.col("len"))
              .filter("ok").select("_rid", "kind", "start", "end"))
    base = F.col("kind").isin(*BASE)
    placed = _without_overlap(placed, base, ~base)
    return _without_overlap(placed, F.col("kind").isin(3, 4), F.col("kind") == 5)


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Base spans, and the weak spans whose complementary parts start within ``reach`` characters."""
    weak = parts.filter(~F.col("kind").isin(*BASE))
    bin_ = F.floor(F.col("start") / reach)
    ident, secret = F.col("kind").isin(*IDENT), F.col("kind").isin(*SECRET)
    bins = (parts.groupBy(F.col("_rid").alias("_r"), bin_.alias("bin")).agg(
        F.min(F.when(ident, F.col("start"))).alias("i0"), F.max(F.when(ident, F.col("start"))).alias("i1"),
        F.min(F.when(secret, F.col("start"))).alias("s0"), F.max(F.when(secret, F.col("start"))).alias("s1")))
    looks = weak.withColumn("look", F.explode(F.array(bin_ - 1, bin_, bin_ + 1)))

    def near(*ends):
        hit = F.lit(False)
        for e in ends:
            hit = hit | F.coalesce(F.abs(F.col(e) - F.col("start")) <= reach, F.lit(False))
        return F.max(hit)

    met = (looks.join(bins, (F.col("_rid") == F.col("_r")) & (F.col("look") == F.col("bin")))
           .groupBy("_rid", "kind", "start", "end").agg(near("i0", "i1").alias("ident"), near("s0", "s1").alias("secret")))
    ok = (F.when(F.col("kind") == 3, F.col("secret")).when(F.col("kind") == 5, F.col("ident"))
          .otherwise(F.col("ident") & F.col("secret")))
    return parts.filter(F.col("kind").isin(*BASE)).unionByName(met.filter(ok).select("_rid", "kind", "start", "end"))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, and findings
    (array of kind, start, end; end exclusive, in code points).

    spans lists all findings as kind:start:end by start, then kind (base kinds first), joined by commas; base_sha256 is
    the digest of the base kinds' part of it. Null and empty texts have no findings. Null or repeated
    doc_ids are ordinary rows. An empty table gives an empty result.
    """
    found = stage(candidates(docs), "secret-candidates")
    parts = stage(spans(found), "secret-spans")
    per_doc = linked(parts, reach).groupBy("_rid").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))  # one document's findings
    name = F.array(*[F.lit(k) for k in KINDS])
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def listed(items):
        return F.array_join(F.transform(items, lambda s: F.concat_ws(
            ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")

    out = found.select("_rid", "doc_id").join(per_doc, "_rid", "left").withColumn("all", F.coalesce("all", empty))
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.filter("all", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        listed(F.col("all")).alias("spans"),
        F.transform("all", lambda s: F.struct(F.element_at(name, s["kind"] + 1).alias("kind"), s["start"].alias("start"),
                                              s["end"].alias("end"))).alias("findings"))
