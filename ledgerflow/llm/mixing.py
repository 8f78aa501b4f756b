"""Mixing sources to target weights through a tree domain - language - source, in DataFrame functions only.

A token budget for the whole corpus is handed down the tree. A node's children share its budget by their weights, but no
child gets more than its subtree can give, which is its tokens times ``EPOCHS``. What a child cannot take goes to its
siblings by their weights; only what no sibling can take stays unspent in the level above, where the same rule has already
filled the node's own siblings. All shares are whole numbers that add up exactly.

A leaf (one source in one language) spends its budget over epochs. Each epoch has its own order of the leaf's documents, by
a hash of seed, epoch and document. Whole epochs come first; of the last one the budget takes a prefix, with the last
document cut to the tokens that are left. A token is a word.

The prefix needs no sort of a leaf: documents fall into 256 ranges of the hash, the sums of the ranges show in
which one the budget ends, and that range is cut again in the same way; only what then lies in the last range is ordered.

Edge cases: a null or empty text has no tokens: it lies in whole epochs, and in the prefix before the place where the
budget ends. A null language or source is a node named ``none``. Names without a target weight have weight 1; a weight
of 0 takes nothing, and its tokens do not count for the budget. Repeated rows (equal doc_id and text) are taken one by
one. An empty table gives an empty result. Other columns are passed on as they are."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import ROW, numbered, store, words

EPOCHS = 4
#: Two hex digits a level: 256 ranges each.
LEVELS = 3
LEAF = ["domain", "lang", "source"]
LONG = "long"


@dataclass(frozen=True)
class Mix:
    """Target weights by name, the domain of each source, the seed, and the budget as a share of all tokens."""

    domains: dict[str, str] = field(default_factory=dict)
    other_domain: str = "other"
    domain_weights: dict[str, int] = field(default_factory=dict)
    language_weights: dict[str, int] = field(default_factory=dict)
    source_weights: dict[str, int] = field(default_factory=dict)
    budget_percent: int = 100
    seed: int = 17


#: The production mix of the given tables: twenty sources in three domains.
MIX = Mix(
    domains={f"src{at}": "reference" if at % 5 == 1 else "forum" if at % 5 == 3 else "web" for at in range(20)},
    domain_weights={"web": 5, "reference": 3, "forum": 2},
    language_weights={"en": 4, "fr": 2, "de": 2, "es": 2},
    source_weights={"src0": 3},
    budget_percent=90,
)


def _lookup(name: Column, values: dict, other) -> Column:
    found = F.lit(other)
    if values:
        pairs = [F.lit(part) for key, value in values.items() for part in (key, value)]
        found = F.coalesce(F.element_at(F.create_map(*pairs), name), found)
    return found


def leaf_columns(mix: Mix) -> list[Column]:
    lang, source = F.coalesce("lang", F.lit("none")), F.coalesce("source", F.lit("none"))
    return [_lookup(source, mix.domains, mix.other_domain).alias("domain"), lang.alias("lang"), source.alias("source")]


def shares(children: DataFrame, parents: list[str]) -> DataFrame:
    """(..., budget) for children with name, weight, capacity and the ``parent_budget`` of their common ``parents``.

    Children in order of capacity by weight: one is filled up while its fair share of what is left reaches its capacity;
    the others divide the rest by weight, in whole tokens."""
    window = Window.partitionBy(*(parents or [F.lit(0)]))
    ordered = window.orderBy((F.col("capacity") / F.col("weight")).asc(), F.col("name").asc())
    before, from_here = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(0, Window.unboundedFollowing)
    until = ordered.rowsBetween(Window.unboundedPreceding, 0)
    left = F.greatest(F.col("parent_budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)), F.lit(0))
    state = children.withColumn("left", left).withColumn("weights", F.sum("weight").over(from_here))
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    state = state.withColumn("full", wide("capacity") * wide("weights") <= wide("weight") * wide("left"))
    state = state.withColumn("rest", F.max(F.when(~F.col("full"), F.col("left"))).over(window))
    state = state.withColumn("open", F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight")).cast(LONG))
    state = state.withColumn("upto", F.sum("open").over(until)).withColumn("opens", F.sum("open").over(window))
    part = lambda weight: F.expr(f"cast(cast(rest as decimal(19,0)) * cast({weight} as decimal(18,0)) div opens as bigint)")
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(part("upto") - part("(upto - open)"))
    return state.withColumn("budget", budget)


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, budget) from the leaves' token sums."""
    weights = {"domain": mix.domain_weights, "lang": mix.language_weights, "source": mix.source_weights}
    sized = leaves.withColumn("capacity", F.col("tokens") * EPOCHS)
    for level in LEAF:
        sized = sized.withColumn(f"{level}_weight", _lookup(F.col(level), weights[level], 1).cast(LONG))
    # A child that may take nothing gives its parent no capacity.
    sized = sized.filter(" and ".join(f"{level}_weight > 0" for level in LEAF))
    current, parents = None, []
    for level in LEAF:
        sums = [F.sum(name).alias(name) for name in ("capacity", "tokens")]
        nodes = sized.groupBy(*parents, level).agg(*sums, F.max(f"{level}_weight").alias("weight"))
        if current is None:  # one row per domain
            whole = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("parent_budget", whole).withColumn(
                "parent_budget", F.expr(f"parent_budget * {mix.budget_percent} div 100")
            )
        else:
            nodes = nodes.join(current.select(*parents, F.col("budget").alias("parent_budget")), parents)
        current = shares(nodes.withColumn("name", F.col(level)), parents)
        parents = [*parents, level]
    return current.select(*LEAF, "tokens", "budget")


def _place(mix: Mix) -> Column:
    """Hex digits that order the documents of an epoch."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    return F.md5(F.concat_ws("|", F.lit(str(mix.seed)), F.col("epoch").cast("string"), name, F.col("text_hash")))


def prefix_ends(placed: DataFrame, rest: DataFrame) -> DataFrame:
    """Per leaf of ``rest`` (leaf, need): the row (place, row number) in which its needed tokens end, and how many of that
    row's tokens they take. ``placed`` has the leaf, place, row number and tokens."""
    current, need = placed, rest
    for level in range(LEVELS):
        cut = current.withColumn("range", F.substring("place", 1 + 2 * level, 2))
        sums = cut.groupBy(*LEAF, "range").agg(F.sum("tokens").alias("tokens")).join(need, LEAF)
        upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("range"))
        ends = sums.withColumn("upto", upto).filter("upto >= need and upto - tokens < need")
        need = store(ends.select(*LEAF, "range", (F.col("need") - F.col("upto") + F.col("tokens")).alias("need")), "prefix_ranges")
        current = cut.join(need.select(*LEAF, "range"), [*LEAF, "range"]).drop("range")
        need = need.drop("range")
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("place", ROW))
    ends = current.join(need, LEAF).withColumn("upto", upto).filter("upto >= need and upto - tokens < need")
    return ends.select(*LEAF, F.col("place").alias("end_place"), F.col(ROW).alias("end_row"), (F.col("need") - F.col("upto") + F.col("tokens")).alias("end_taken"))


def _sized(docs: DataFrame, mix: Mix) -> list[Column]:
    text_hash = F.md5(F.coalesce("text", F.lit(""))).alias("text_hash")
    return [F.col("doc_id"), text_hash, *leaf_columns(mix), F.size(words(F.col("text"))).cast(LONG).alias("tokens")]


def taken_rows(rows: DataFrame, mix: Mix) -> DataFrame:
    """The numbered rows (doc_id, text_hash, leaf, tokens, ...) once for each epoch that takes them, with ``epoch`` and the
    number of tokens ``taken``.

    Only sums per leaf and range leave the scan: a row finds what it needs in tables with one row per leaf."""
    leaves = rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"))
    spent = budgets(leaves, mix).filter("budget > 0").withColumn("whole", F.expr("budget div tokens"))
    spent = store(spent.withColumn("need", F.col("budget") - F.col("whole") * F.col("tokens")).drop("tokens"), "mixing_budgets")
    small = rows.select("doc_id", "text_hash", *LEAF, "tokens", ROW)
    rest = spent.filter("need > 0").select(*LEAF, "need")
    place = lambda frame: frame.withColumn("epoch", F.col("whole") + 1).withColumn("place", _place(mix))
    placed = place(small.join(spent.filter("need > 0").select(*LEAF, "whole"), LEAF)).select(*LEAF, "tokens", ROW, "place")
    ends = store(prefix_ends(placed, rest), "mixing_ends")
    known = place(rows.join(spent.select(*LEAF, "whole").join(ends, LEAF, "left"), LEAF))
    here, end = F.struct("place", ROW), F.struct(F.col("end_place").alias("place"), F.col("end_row").alias(ROW))
    before = F.coalesce(F.col("end_place").isNotNull() & (here < end), F.lit(False))
    at_end = F.coalesce(F.col("end_row") == F.col(ROW), F.lit(False))
    known = known.withColumn("last", F.when(before, F.col("tokens")).when(at_end, F.col("end_taken")))
    epochs = F.sequence(F.lit(1).cast(LONG), F.col("whole") + F.when(F.col("last").isNull(), 0).otherwise(1))
    reached = known.filter("whole > 0 or last is not null").withColumn("epoch", F.explode(epochs))
    taken = F.when(F.col("epoch") <= F.col("whole"), F.col("tokens")).otherwise(F.col("last"))
    return reached.withColumn("taken", taken).drop("whole", "place", "last", "end_place", "end_row", "end_taken")


def mixed(docs: DataFrame, mix: Mix = MIX) -> DataFrame:
    """(doc_id, domain, lang, source, epoch, tokens, taken): what each epoch takes of each document."""
    rows = numbered(docs.select(*_sized(docs, mix)), "mixing_rows")
    return taken_rows(rows, mix).select("doc_id", *LEAF, "epoch", "tokens", "taken")


def mix_documents(docs: DataFrame, mix: Mix = MIX) -> DataFrame:
    """The documents as the mix takes them, a row for each epoch. Of a document cut by the budget the text is its first
    words, joined by spaces. ``n_chars``, where there, is the new length."""
    columns = docs.columns
    row = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("_row_")
    taken = taken_rows(numbered(docs.select(row, *_sized(docs, mix)), "mixing_documents"), mix)
    own = F.col("_row_.text")
    cut = F.array_join(F.slice(words(own), 1, F.col("taken").cast("int")), " ")
    text = taken.select("_row_", F.when(F.col("taken") < F.col("tokens"), cut).otherwise(own).alias("_text_"))
    new = {"text": F.col("_text_"), "n_chars": F.char_length("_text_").cast(LONG)}
    return text.select(*[new.get(name, F.col(f"_row_.`{name}`")).alias(name) for name in columns])


def _case(column: str, values: dict, other) -> str:
    quoted = lambda value: f"'{value}'" if isinstance(value, str) else str(value)
    whens = " ".join(f"WHEN '{key}' THEN {quoted(value)}" for key, value in values.items())
    return f"CASE {column} {whens} ELSE {quoted(other)} END" if values else quoted(other)


def mixed_sql(mix: Mix = MIX) -> str:
    """The same result in DuckDB, with a plain sort of every leaf."""
    weights = {"domain": mix.domain_weights, "lang": mix.language_weights, "source": mix.source_weights}
    steps = [
        f"""sized AS (SELECT doc_id, md5(coalesce(text, '')) AS text_hash, {_case("source", mix.domains, mix.other_domain)} AS domain,
            coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents)""",
        f"""leaves AS (SELECT *, tokens * {EPOCHS} AS capacity FROM (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens
            FROM sized GROUP BY ALL) WHERE {" AND ".join(f"{_case(level, weights[level], 1)} > 0" for level in LEAF)})""",
    ]
    parents: list[str] = []
    for number, level in enumerate(LEAF):
        keys = ", ".join([*parents, level])
        over = f"PARTITION BY {', '.join(parents)}" if parents else ""
        order = f"{over} ORDER BY capacity / weight, {level}"
        above = (
            f"JOIN (SELECT {', '.join(parents)}, budget AS parent_budget FROM share{number - 1}) USING ({', '.join(parents)})"
            if parents
            else f"CROSS JOIN (SELECT sum(tokens) * {mix.budget_percent} // 100 AS parent_budget FROM leaves)"
        )
        steps += [
            f"""node{number} AS (SELECT * FROM (SELECT {keys}, sum(capacity)::HUGEINT AS capacity, sum(tokens)::HUGEINT AS tokens,
                {_case(level, weights[level], 1)}::HUGEINT AS weight FROM leaves GROUP BY {keys}) {above})""",
            f"""state{number} AS (SELECT *, greatest(parent_budget - coalesce(sum(capacity) OVER (
                {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS remaining,
                sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM node{number})""",
            f"""open{number} AS (SELECT *, capacity * weights <= weight * remaining AS filled,
                CASE WHEN capacity * weights <= weight * remaining THEN 0 ELSE weight END AS open_weight FROM state{number})""",
            f"""rest{number} AS (SELECT *, max(CASE WHEN NOT filled THEN remaining END) OVER ({over}) AS rest,
                sum(open_weight) OVER ({order} ROWS UNBOUNDED PRECEDING) AS upto, sum(open_weight) OVER ({over}) AS opens FROM open{number})""",
            f"""share{number} AS (SELECT {keys}, tokens, CASE WHEN filled THEN capacity
                ELSE rest * upto // opens - rest * (upto - open_weight) // opens END AS budget FROM rest{number})""",
        ]
        parents.append(level)
    steps += [
        "spent AS (SELECT domain, lang, source, budget, budget // tokens AS whole, budget % tokens AS need FROM share2 WHERE budget > 0)",
        f"""placed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - tokens AS before
            FROM (SELECT *, md5(concat_ws('|', '{mix.seed}', (whole + 1)::VARCHAR, coalesce(doc_id::VARCHAR, 'none'), text_hash)) AS place
            FROM sized JOIN spent USING (domain, lang, source)))""",
        """taken AS (SELECT doc_id, domain, lang, source, unnest(range(1, whole::BIGINT + 1)) AS epoch, tokens, tokens AS taken FROM placed
            UNION ALL SELECT doc_id, domain, lang, source, whole + 1, tokens, least(tokens, need - before) FROM placed WHERE before < need)""",
    ]
    return f"WITH {', '.join(steps)} SELECT doc_id, domain, lang, source, epoch::BIGINT AS epoch, tokens, taken::BIGINT AS taken FROM taken"
