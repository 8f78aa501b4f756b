"""Secrets by corpus-wide ownership frequency, in DataFrame functions only.

Three fixed patterns give the base spans. Their values, and every other run of six or more characters of an assigned
value's class, with the parts of it between dots, equals signs and slashes, are candidates; they are compared by their
hashes. A hash is counted over distinct owners (source) and distinct repositories
(source and language), whether it stands as a base value or bare; equal pairs are put together before the shuffle. A base
value that many owners or many repositories hold is a copied example, any other is a live-looking credential. Tokens elsewhere that equal a live-looking credential are added as spans of kind ``reuse``.

Edge cases: a null text counts as empty; a null source or language is an owner of its own. Repeated rows get the same
result each and count as one owner. Values of any length are kept whole; a text takes time in proportion to its length and
its matches. An empty table gives an empty result. Input
columns other than doc_id, text, source and lang are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import ROW, numbered, span_text, store

KINDS = ("assign", "access", "hex", "reuse")
REUSE = len(KINDS) - 1

# The base patterns. The two with a minimum length find the same as the open form with a length check.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LENGTH = 6

#: Tokens that may be a credential used without a name before it: runs of the assign value's class without dots at their
#: edges, and the parts between dots, between equals signs (but for those that end a value), between slashes, or between more than one of these.
BARE = (
    r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{4,}[A-Za-z0-9+/_=-]",
    r"[A-Za-z0-9+/_=-]{6,}",
    r"[A-Za-z0-9+/_-](?:[A-Za-z0-9+/_.-]*[A-Za-z0-9+/_-])?={0,2}",
    r"[A-Za-z0-9+_=-][A-Za-z0-9+_.=-]{4,}[A-Za-z0-9+_=-]",
    r"[A-Za-z0-9+_-][A-Za-z0-9+_.-]{4,}[A-Za-z0-9+_-]",
    r"[A-Za-z0-9+_-]{6,}",
)
#: A value that so many owners, or so many repositories of fewer owners, hold is an example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 4

# Two private code points mark match boundaries; in the text the first is read as the second, which no pattern matches.
# Matches are put together in lists of this length, as appending to a list copies it.
_TOGETHER = 512
_MARK, _OTHER = "\ue000", "\ue001"


def _pieces(text: Column, pattern: str) -> Column:
    """Gaps and matches in turn: matches stand at odd positions (from 0)."""
    return F.split(F.regexp_replace(text, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK)


def _matches(text: Column, pattern: str, kind: int, hashes: Column | None = None) -> Column:
    """Matches with code point positions: array of struct (start, kind, end, value); only those of given hashes, if any."""
    none = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.char_length(piece)
        match = F.struct(state["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"), piece.alias("value"))
        wanted = state["hit"] if hashes is None else state["hit"] & F.array_contains(hashes, _digest(piece))
        found = F.when(wanted, F.concat(state["found"], F.array(match))).otherwise(state["found"])
        return F.struct(end.alias("at"), (~state["hit"]).alias("hit"), found.alias("found"))

    def in_lists(pieces: Column) -> Column:
        """Positions at which the lists of pieces start, then the matches of each list."""
        lists = F.transform(F.sequence(F.lit(1), F.size(pieces), F.lit(_TOGETHER)), lambda at: F.slice(pieces, at, _TOGETHER))
        size = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda total, piece: total + F.char_length(piece))
        first = F.array(F.lit(0).cast("long"))
        starts = F.aggregate(F.transform(lists, size), first, lambda ends, more: F.concat(ends, F.array(F.element_at(ends, -1) + more)))
        start = lambda at: F.struct(at.alias("at"), F.lit(False).alias("hit"), F.array().cast(none).alias("found"))
        return F.flatten(F.zip_with(lists, F.slice(starts, 1, F.size(lists)), lambda part, at: F.aggregate(part, start(at), step, lambda state: state["found"])))

    hits = F.element_at(F.transform(F.array(_pieces(text, pattern)), in_lists), 1)
    return F.when(F.regexp_like(text, F.lit(pattern)), hits).otherwise(F.array().cast(none))


def _trimmed(value: Column) -> Column:
    """Dots at the edges of a value belong to the sentence."""
    return F.btrim(value, F.lit("."))


def _digest(value: Column) -> Column:
    return F.sha2(_trimmed(value), 256)


def _value(match: Column) -> Column:
    return F.when(match["kind"] == 0, F.regexp_extract(match["value"], ASSIGN, 1)).otherwise(match["value"])


def find_base(docs: DataFrame) -> DataFrame:
    """Per row: the text, its owner and repository, and the base spans with the hash of their value."""
    text = F.translate(F.coalesce("text", F.lit("")), _MARK, _OTHER)
    owner, repository = F.coalesce("source", F.lit("\0")), F.concat_ws("\0", F.coalesce("source", F.lit("\0")), "lang")
    frame = docs.select("doc_id", text.alias("t"), owner.alias("owner"), repository.alias("repository"))
    hits = frame.select(
        "*",
        _matches(F.col("t"), ASSIGN, 0).alias("assign"),
        _matches(F.col("t"), ACCESS, 1).alias("access"),
        _matches(F.col("t"), HEX, 2).alias("hex"),
    )
    long_enough = lambda m: F.char_length(F.regexp_extract(m["value"], ASSIGN, 1)) >= ASSIGN_LENGTH
    plain = lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))
    hashed = lambda m: F.struct(plain(m).alias("span"), _digest(_value(m)).alias("hash"), F.xxhash64(_trimmed(_value(m))).alias("key"))
    base = F.concat(F.filter("assign", long_enough), "access", "hex")
    return hits.select("doc_id", "t", "owner", "repository", F.transform(base, hashed).alias("base"))


#: A run that holds every match of ``BARE`` that has a character of it, and the marks that make it hold others than itself.
_RUN, _CUT = r"[A-Za-z0-9+/_.=-]{6,}", "[./=]"


def _tokens(text: Column) -> Column:
    """The distinct matches of all ``BARE`` patterns: the text is searched once, and only runs with cuts again."""
    runs = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_RUN), F.lit(0)), _trimmed))
    inside = lambda run: F.flatten(F.array(*[F.regexp_extract_all(run, F.lit(pattern), F.lit(0)) for pattern in BARE[1:]]))
    parts = lambda runs: F.array_distinct(F.concat(runs, F.flatten(F.transform(F.filter(runs, lambda run: run.rlike(_CUT)), inside))))
    return F.element_at(F.transform(F.array(runs), parts), 1)


def _bare(found: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """(columns, hash) of each row's distinct bare candidates, outside of base matches, with one of the keys: there are far more
    candidates than values, so a short key sorts most of them out before anything is hashed or shuffled."""
    outside = F.regexp_replace("t", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    token = F.explode(_tokens(F.when(F.size("base") > 0, outside).otherwise(F.col("t")))).alias("token")
    candidates = found.select(*columns, token).filter(F.length("token") >= ASSIGN_LENGTH).withColumn("key", F.xxhash64("token"))
    return candidates.join(keys, "key").select(*columns, _digest(F.col("token")).alias("hash"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories, bare) of all base values, counted from distinct pairs of their base and bare occurrences;
    ``bare`` where any of them is bare."""
    base = found.select(F.explode("base").alias("b"), "owner", "repository").select("b.hash", "b.key", "owner", "repository").distinct()
    base = store(base, "secret_base_pairs")
    keys = store(base.select("key").distinct(), "secret_base_keys")
    bare = _bare(found, keys, "owner", "repository").distinct().join(base.select("hash").distinct(), "hash")
    both = base.drop("key").withColumn("bare", F.lit(False)).unionByName(bare.withColumn("bare", F.lit(True)))
    pairs = both.groupBy("hash", "owner", "repository").agg(F.max("bare").alias("bare"))
    per_owner = pairs.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.max("bare").alias("bare"))
    return per_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("bare").alias("bare")
    )


def _reused(found: DataFrame, live: DataFrame) -> DataFrame:
    """(row number, added array of spans): bare candidates that equal a live value and overlap no base span."""
    keys = found.select(F.explode("base").alias("b")).select("b.hash", "b.key").distinct().join(live, "hash").select("key").distinct()
    rows = _bare(found, store(keys, "secret_live_keys"), ROW).join(live, "hash").groupBy(ROW).agg(F.collect_set("hash").alias("reused"))
    texts = found.join(store(rows, "secret_reuse_rows"), ROW).select(ROW, "t", "reused", "base.span")
    texts = store(texts, "secret_reuse_texts")
    matches = [_matches(F.col("t"), pattern, REUSE, F.col("reused")) for pattern in BARE]
    found = texts.select(ROW, F.explode(F.concat(*matches)).alias("m")).select(ROW, "m.start", "m.end").distinct()
    # A match is covered if a base span that starts before the match's end ends after its start.
    ends = found.select(ROW, F.col("end").alias("at"), F.lit(0).alias("is_base"), "start", "end")
    bases = texts.select(ROW, F.explode("span").alias("s")).select(ROW, F.col("s.start").alias("at"), F.lit(1).alias("is_base"), "s.start", "s.end")
    before = Window.partitionBy(ROW).orderBy("at", "is_base").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(F.col("is_base") == 1, F.col("end"))).over(before)
    clear = ends.unionByName(bases).withColumn("reach", F.coalesce(reach, F.lit(0))).filter("is_base = 0 and reach <= start")
    span = F.struct("start", F.lit(REUSE).alias("kind"), "end")
    return clear.groupBy(ROW).agg(F.collect_set(span).alias("added"))


def secrets(docs: DataFrame) -> DataFrame:
    found = numbered(find_base(docs), "secret_candidates")
    owners = store(ownership(found), "secret_ownership")
    is_live = (F.col("owners") < EXAMPLE_OWNERS) & (F.col("repositories") < EXAMPLE_REPOSITORIES)
    judged = found.select(ROW, F.explode("base.hash").alias("hash")).join(owners.select("hash", is_live.alias("live")), "hash")
    per_row = judged.groupBy(ROW).agg(F.count(F.when(F.col("live"), 1)).alias("n_live"), F.count(F.when(~F.col("live"), 1)).alias("n_example"))
    added = store(_reused(found, owners.filter(is_live & F.col("bare")).select("hash")), "secret_reuse")
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    whole = found.select("doc_id", ROW, "base").join(per_row, ROW, "left").join(added, ROW, "left").fillna(0, ["n_live", "n_example"])
    spans = F.col("base.span")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return whole.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(span_text(spans, KINDS), 256).alias("base_sha256"),
        span_text(F.concat(spans, F.coalesce("added", nothing)), KINDS).alias("spans"),
        "n_live",
        "n_example",
    )
