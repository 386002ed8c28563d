"""Secret scan by corpus-wide ownership frequency, in built-in functions only.

One projection cuts every whole text at its matches and gives their spans:

* base kinds ``assign``, ``access`` and ``hex``: leftmost non-overlapping matches of a fixed
  pattern each; an assignment whose value is shorter than 12 characters is dropped after matching;
* other tokens of 20 characters or more that hold a digit and lie outside the base matches.

Each match carries a hash of its value.  The method then counts, over the whole
corpus, the distinct repositories and owners of every hash.  A value that looks
live (letters and digits, ``DISTINCT`` different characters) and belongs to one
owner in at most ``MAX_REPOS`` repositories is a credential of that owner; a value
that several owners or many repositories hold is a copied example.  Base spans
always stay and are only counted by that verdict; other tokens become spans of kind
``live`` if they are a credential with upper and lower case letters.

The corpus names no repositories: the owner is ``source`` and every document counts
as a repository of its own (``owner`` and ``repo`` choose other columns).

A hash that a third of the corpus holds is counted from distinct (hash, owner,
repository) rows in two steps, and its verdict goes back through (hash, salt)
pairs, so no task meets all its rows.

Defined cases: a null text is empty (no spans, the hash of the empty string);
a null owner is an owner of its own, as is a null repository; equal rows give equal
rows, and repeated ids are kept apart by their texts; an empty table gives an
empty result; extra columns, whatever their names, are ignored.  Positions count
code points.  A long text is scanned whole, and its spans are added up in blocks, in linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstat.llm.common import staged

# Kinds in their order, and the patterns of the base matches.
KINDS = ["assign", "access", "hex", "live"]
ASSIGN = r"""(?=[pPsStTaA])((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"          # runs end where the class ends, so short runs can be left out while matching
HEX = r"[0-9a-f]{16,}"
MIN_VALUE = 12
#: A token with a digit that no base match has consumed.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z+/_-]*+[0-9][A-Za-z0-9+/_-]*+(?<=[A-Za-z0-9+/_-]{20})={0,2}"
ONLY_TOKEN = r"^[A-Za-z0-9+/_-]{20,}={0,2}$"

MAX_REPOS = 3
DISTINCT = 10
SALTS = 64
BLOCK = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a column named inside a lambda is computed again for every element."""
    return F.transform(F.array(value), use)[0]


def _sums(steps: Column) -> Column:
    """Running sums of an array, in blocks so that a long one takes linear time."""
    zero = F.array().cast("array<bigint>")
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("bigint"))
    grow = lambda acc, x: F.concat(acc, F.array(last(acc) + x))
    starts = lambda a: F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(BLOCK))
    blocks = _let(steps, lambda a: F.transform(starts(a), lambda i: F.aggregate(F.slice(a, i, F.lit(BLOCK)), zero, grow)))

    def shifted(inner: Column) -> Column:
        before = F.slice(F.aggregate(F.transform(inner, last), F.array(F.lit(0).cast("bigint")), grow), F.lit(1), F.size(inner))
        return F.flatten(F.zip_with(inner, before, lambda sums, base: F.transform(sums, lambda x: x + base)))

    return _let(blocks, shifted)


def matches(text: Column, pattern: str, only_if: str | None = None) -> Column:
    """array<struct<start, end, hit>> of the leftmost non-overlapping matches, in code points; none in texts without ``only_if``."""
    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        ends = _sums(F.zip_with(gaps, hits, lambda g, h: (F.length(g) + F.length(h)).cast("bigint")))
        return F.zip_with(ends, hits, lambda end, h: F.struct((end - F.length(h)).alias("start"), end.alias("end"), h.alias("hit")))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    return F.when(text.rlike(only_if or pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(empty)


def _hash(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _looks_live(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT)


def scan(docs: DataFrame, owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``owner``, ``repo``, ``row`` (a hash of the whole input of the verdict), and ``spans`` with the hash of each value."""
    text = F.coalesce(F.col("text"), F.lit(""))
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    cut = docs.select(F.col("doc_id"), quoted(owner).cast("string").alias("owner"), quoted(repo).cast("string").alias("repo"),
                      F.xxhash64(text).alias("body"), *[matches(text, p).alias(k) for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX))],
                      matches(text, f"(?:{ASSIGN})|(?:{ACCESS})|(?:{HEX})|{TOKEN}", only_if=TOKEN).alias("live"))

    def spans(kind: str, keep=None, value=lambda hit: hit) -> Column:
        held = F.col(kind) if keep is None else F.filter(kind, lambda m: keep(m["hit"]))
        return F.transform(held, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"),
                                                    _hash(value(m["hit"])).alias("hash"), _looks_live(value(m["hit"])).alias("looks")))

    secret = lambda hit: F.regexp_extract(hit, ASSIGN, 2)
    token = lambda hit: (hit.rlike(ONLY_TOKEN) & ~hit.rlike("^[0-9a-f]+$") & ~hit.rlike("^AKIA[A-Z0-9]+$")
                         & hit.rlike("[A-Z]") & hit.rlike("[a-z]") & _looks_live(hit))
    found = F.concat(spans("assign", lambda hit: F.length(secret(hit)) >= MIN_VALUE, secret), spans("access"), spans("hex"), spans("live", token))
    row = F.xxhash64("doc_id", "owner", "repo", "body")
    return cut.select("doc_id", "owner", "repo", row.alias("row"), found.alias("spans"))


def verdicts(scanned: DataFrame) -> DataFrame:
    """(doc_id, row, hash) of every value that is a credential of one owner."""
    seen = (scanned.select("doc_id", "row", "owner", "repo", F.explode("spans").alias("s"))
            .select("doc_id", "row", "owner", "repo", F.col("s.hash").alias("hash"), F.col("s.looks").alias("looks")).distinct())
    # distinct owners and repositories of a hash, counted in steps that spread a hash over its repositories
    per_owner = seen.groupBy("hash", "owner", "repo").agg(F.max("looks").alias("looks")).groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repos"), F.max("looks").alias("looks"))
    counts = per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.max("looks").alias("looks"))
    live = counts.filter((F.col("owners") == 1) & (F.col("repos") <= MAX_REPOS) & F.col("looks")).select("hash")
    salted = seen.withColumn("salt", F.pmod("row", F.lit(SALTS)))
    pairs = salted.select("hash", "salt").distinct().join(live, "hash", "left_semi")
    return salted.join(pairs, ["hash", "salt"], "left_semi").select("doc_id", "row", "hash")


def find(docs: DataFrame, owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base spans, all ``spans``, and how the corpus judges them.

    ``n_live`` and ``n_copied`` split the base spans by the verdict on their values;
    ``n_added`` counts the spans that the method adds.
    """
    scanned = staged(scan(docs, owner, repo), "secret-scan")
    judged = verdicts(scanned).groupBy(F.col("doc_id").alias("id"), F.col("row").alias("at")).agg(F.collect_set("hash").alias("live"))
    both = scanned.join(judged, scanned["doc_id"].eqNullSafe(judged["id"]) & (scanned["row"] == judged["at"]), "left").drop("id", "at")
    live = F.coalesce("live", F.array().cast("array<binary>"))
    marked = both.withColumn("spans", F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.array_contains(live, s["hash"]).alias("live")))))
    base, added = (F.filter("spans", lambda s: s["kind"] < 3), F.filter("spans", lambda s: (s["kind"] < 3) | s["live"]))
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda a: F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])))
    count = lambda keep: F.size(F.filter("spans", keep)).cast("bigint")
    of_kind = lambda k: count(lambda s: s["kind"] == k)
    return marked.select(
        "doc_id", *[of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(added).alias("spans"),
        count(lambda s: (s["kind"] < 3) & s["live"]).alias("n_live_base"), count(lambda s: (s["kind"] < 3) & ~s["live"]).alias("n_copied_base"),
        count(lambda s: (s["kind"] == 3) & s["live"]).alias("n_added"))
