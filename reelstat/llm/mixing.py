"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Tokens are counted by source, language and topic. Raking scales the cells until the shares of
sources, of languages and of topics all meet their targets; a document is then sampled with the
probability that its cell's factor gives, so the expected tokens of the sample have the targets'
shares. With a budget the sample has a stated share of all tokens: no probability passes 1, cells that
reach it are taken whole, and the others are raked to what is left of the targets. A source, language
or topic that has fewer tokens than its target asks for gives all, and the others share the rest.

Sources may be many and stay distributed, one row each. The driver holds the table of languages by
topics, whose size is checked, and one factor for each language and topic.

Defined results: a null in source, language or topic counts as the value ``(none)``; documents
without tokens get the probability of their cell, or 0 if the whole cell has no tokens; a value whose
target is missing or 0 gets the probability 0, and the other targets share its part; rows with equal
ids are drawn alike; a table without tokens gives probability 0 throughout, an empty one no rows;
columns that clash with the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import WORD
from reelstat.session import written

NONE = "(none)"
#: Languages times topics that the driver may hold.
MAX_PAIRS = 20_000

LICENCE = r"(?i)licensed under|released under|is licensed|all rights reserved"
CONTACT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]"


def n_tokens(text_column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long")


def topic_of(text_column: str = "text") -> Column:
    """A coarse topic by what a text contains; pass another column for a finer one."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return (
        F.when(F.regexp_like(text, F.lit(LICENCE)), "licensed")
        .when(F.regexp_like(text, F.lit(CONTACT)), "contact")
        .otherwise("prose")
    )


def flattened(cells: DataFrame, column: str, power: float) -> DataFrame:
    """Targets that lie between the natural shares (power 1) and equal ones (power 0)."""
    sums = cells.groupBy(column).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    return sums.select(
        F.col(column).alias("value"), F.pow(F.col("tokens").cast("double"), power).alias("share")
    )


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = 60, tolerance: float = 1e-12,
    budget: float | None = None,
) -> DataFrame:
    """The cells (source, lang, topic, tokens) with the factor of each.

    ``targets`` has for each of the three columns a table (value, share); shares need not sum to 1.
    Factors are scaled so that tokens * factor sums to 1, or, with a budget in tokens, to the budget
    (or to all tokens that have a target, if they are fewer) with no factor over 1.
    """
    spark = cells.sparkSession
    goals = {
        name: {r["value"]: float(r["share"]) for r in targets[name].collect()}
        for name in ("lang", "topic")
    }
    if len(goals["lang"]) * len(goals["topic"]) > MAX_PAIRS:
        raise ValueError(f"over {MAX_PAIRS} pairs of languages and topics; make topics coarser")
    known = cells.filter("tokens > 0").filter(
        F.col("lang").isin([k for k, v in goals["lang"].items() if v > 0])
        & F.col("topic").isin([k for k, v in goals["topic"].items() if v > 0])
    )
    wanted = targets["source"].filter("share > 0").select(
        F.col("value").alias("source"), F.col("share").cast("double").alias("goal")
    )
    # One row a source; its list has at most languages times topics entries.
    by_source = known.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "tokens")).alias("own"))
    sources = written(by_source.join(wanted, "source"), "mix-sources")
    total = sources.agg(F.sum("goal")).first()[0]
    present = {
        name: {r[0] for r in sources.select(F.explode(f"own.{name}").alias("v")).distinct().collect()}
        for name in ("lang", "topic")
    }
    goals = {
        name: {k: v / sum(x for y, x in goal.items() if y in present[name]) for k, v in goal.items() if k in present[name]}
        for name, goal in goals.items()
    }
    factors = {name: dict.fromkeys(goal, 1.0) for name, goal in goals.items()}
    if not total:
        return cells.withColumn("factor", F.lit(0.0))
    if budget is not None:
        return _with_factor(cells, _within(sources, goals, total, budget, rounds))

    for _ in range(rounds):
        sums = _scaled(sources, factors, total).groupBy("lang", "topic").agg(F.sum("weight").alias("weight"))
        pairs = {(r["lang"], r["topic"]): r["weight"] for r in sums.collect()}
        change = 0.0
        for at, name in enumerate(("lang", "topic")):
            for value, goal in goals[name].items():
                now = sum(w for k, w in pairs.items() if k[at] == value)
                ratio = goal / now
                factors[name][value] *= ratio
                change = max(change, abs(ratio - 1))
                pairs = {k: w * ratio if k[at] == value else w for k, w in pairs.items()}
        if change <= tolerance:
            break
    found = _scaled(sources, factors, total).select(
        "source", "lang", "topic", (F.col("weight") / F.col("tokens")).alias("factor")
    )
    return _with_factor(cells, found)


def _with_factor(cells: DataFrame, found: DataFrame) -> DataFrame:
    return cells.join(found, ["source", "lang", "topic"], "left").withColumn(
        "factor", F.coalesce("factor", F.lit(0.0))
    )


def _within(
    sources: DataFrame, goals: Mapping[str, Mapping[str, float]], total: float, budget: float,
    rounds: int, tolerance: float = 1e-9,
) -> DataFrame:
    """(source, lang, topic, factor): raking in which no factor passes 1."""
    tokens = F.aggregate("own.tokens", F.lit(0.0), lambda a, x: a + x)
    sources = sources.withColumn("held", tokens)
    held = {"lang": {}, "topic": {}}
    for r in sources.select(F.explode("own").alias("x")).groupBy("x.lang", "x.topic").agg(
        F.sum("x.tokens").alias("tokens")
    ).collect():
        for name in held:
            held[name][r[name]] = held[name].get(r[name], 0.0) + r["tokens"]
    budget = min(budget, sum(held["lang"].values()))
    wanted = {name: _bounded(goals[name], held[name], budget) for name in held}

    # The same for sources, which may be many: those that give all lie below the scale.
    scale = budget / total
    while True:
        full = F.col("goal") * scale >= F.col("held")
        given, rest = sources.agg(
            F.sum(F.when(full, F.col("held")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("goal")))
        ).first()
        new = (budget - given) / rest if rest else float("inf")
        if new <= scale * (1 + 1e-12) or not rest:
            scale = max(scale, new)
            break
        scale = new
    sources = sources.withColumn("goal", F.least("held", F.col("goal") * F.lit(scale)))

    factors = {name: dict.fromkeys(goal, 1.0) for name, goal in goals.items()}
    for _ in range(rounds):
        sums = _taken(sources, factors).groupBy("lang", "topic").agg(
            F.sum(F.when(F.col("factor") < 1, F.col("tokens") * F.col("factor")).otherwise(0.0)).alias("open"),
            F.sum(F.when(F.col("factor") < 1, 0.0).otherwise(F.col("tokens"))).alias("whole"),
        )
        pairs = {(r["lang"], r["topic"]): (r["open"], r["whole"]) for r in sums.collect()}
        off = 0.0
        for at, name in enumerate(("lang", "topic")):
            for value, goal in wanted[name].items():
                loose = sum(x for k, (x, _) in pairs.items() if k[at] == value)
                whole = sum(x for k, (_, x) in pairs.items() if k[at] == value)
                off = max(off, abs(loose + whole - goal) / budget)
                ratio = (goal - whole) / loose if goal > whole and loose else goal / (loose + whole)
                ratio = min(max(ratio, 1e-3), 1e3)
                factors[name][value] *= ratio
                pairs = {k: (x * ratio, y) if k[at] == value else (x, y) for k, (x, y) in pairs.items()}
        if off <= tolerance:
            break
    return _taken(sources, factors).select("source", "lang", "topic", "factor")


def _bounded(goal: Mapping[str, float], held: Mapping[str, float], budget: float) -> dict[str, float]:
    """Tokens to take of each value: the budget by shares, where no value gives more than it has."""
    taken, rest = {}, {k: v for k, v in goal.items() if k in held}
    while rest:
        scale = (budget - sum(taken.values())) / sum(rest.values())
        full = {k: held[k] for k, v in rest.items() if v * scale >= held[k]}
        if not full:
            return taken | {k: v * scale for k, v in rest.items()}
        taken |= full
        rest = {k: v for k, v in rest.items() if k not in full}
    return taken


def _of(factors: Mapping[str, float], value: Column) -> Column:
    entries = [x for k, v in factors.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*entries), value)


def _taken(sources: DataFrame, factors: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Cells with the factors, 1 at most, with which every source meets its goal."""
    own = F.transform("own", lambda x: F.struct(
        (_of(factors["lang"], x["lang"]) * _of(factors["topic"], x["topic"])).alias("by"),
        x["lang"].alias("lang"), x["topic"].alias("topic"), x["tokens"].cast("double").alias("tokens"),
    ))
    rows = sources.select("source", "goal", F.sort_array(own, asc=False).alias("own"))
    rows = rows.withColumn("all", F.aggregate("own", F.lit(0.0), lambda a, x: a + x["by"] * x["tokens"]))
    # From the largest factor on, what would pass 1 is taken whole and leaves the goal.
    left = F.aggregate(
        "own", F.struct(F.col("goal").alias("goal"), F.col("all").alias("all")),
        lambda a, x: F.when(
            a["goal"] * x["by"] > a["all"],
            F.struct(
                (a["goal"] - x["tokens"]).alias("goal"), (a["all"] - x["by"] * x["tokens"]).alias("all")
            ),
        ).otherwise(a),
    )
    rows = rows.withColumn("left", left)
    rows = rows.withColumn(
        "scale", F.when(F.col("left.all") > F.col("all") * 1e-12, F.col("left.goal") / F.col("left.all"))
        .otherwise(F.lit(float("inf"))),
    ).select("source", "scale", F.explode("own").alias("x"))
    factor = F.greatest(F.least(F.col("scale") * F.col("x.by"), F.lit(1.0)), F.lit(0.0))
    return rows.select("source", "x.lang", "x.topic", "x.tokens", factor.alias("factor"))


def _scaled(sources: DataFrame, factors: Mapping[str, Mapping[str, float]], total: float) -> DataFrame:
    """Cells with the weight they have once every source meets its goal."""
    def of(name: str, value: Column) -> Column:
        entries = [x for k, v in factors[name].items() for x in (F.lit(k), F.lit(v))]
        return F.element_at(F.create_map(*entries), value)

    scaled = F.transform(
        "own",
        lambda x: F.struct(
            x["lang"].alias("lang"), x["topic"].alias("topic"), x["tokens"].alias("tokens"),
            (x["tokens"] * of("lang", x["lang"]) * of("topic", x["topic"])).alias("part"),
        ),
    )
    rows = sources.select("source", "goal", scaled.alias("own"))
    sums = F.aggregate("own.part", F.lit(0.0), lambda a, x: a + x)
    rows = rows.select("source", (F.col("goal") / total / sums).alias("scale"), F.explode("own").alias("x"))
    return rows.select(
        "source", "x.lang", "x.topic", "x.tokens", (F.col("scale") * F.col("x.part")).alias("weight")
    )


def uniform(id_column: str, seed: str) -> Column:
    """A number from 0 to 1 that follows from an id."""
    text = F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


ADDED = ("topic", "n_tokens", "weight", "probability", "sampled")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents with topic, tokens, weight (how much more often a token of the cell is drawn
    than an average one), probability and the draw. Options: see ``drawn``."""
    out = drawn(docs.drop(*ADDED), **options)
    return out.withColumnsRenamed({f"__{name}": name for name in ADDED})


def draws(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source", lang_column: str = "lang", topic: Column | None = None, **options,
) -> DataFrame:
    """As ``mixed``, without the texts, which are read once: (id, source, lang, topic, n_tokens,
    weight, probability, sampled)."""
    slim = written(
        docs.select(
            F.col(id_column).alias(id_column), F.col(source_column).alias("source"),
            F.col(lang_column).alias("lang"),
            (topic if topic is not None else topic_of(text_column)).alias("topic"),
            n_tokens(text_column).alias("n_tokens"),
        ),
        "mix-documents",
    )
    out = drawn(slim, id_column=id_column, topic=F.col("topic"), tokens=F.col("n_tokens"), **options)
    return out.drop(*ADDED).withColumnsRenamed({f"__{name}": name for name in ADDED})


def mix(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents, with the columns of ``docs``."""
    return drawn(docs, **options).filter("__sampled").select(*docs.columns)


def drawn(
    docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, power: float = 0.7,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    lang_column: str = "lang", topic: Column | None = None, seed: str = "mix", rounds: int = 60,
    budget: float | None = None, tokens: Column | None = None,
) -> DataFrame:
    """The documents with the added columns, whose names begin with two underscores.

    Without ``targets`` natural shares are flattened to ``power``. The cell with the largest weight
    is taken whole, and all probabilities follow from it, so no target is cut off. With ``budget``,
    the share of all tokens to keep, rare cells are taken whole and do not decide on the others.
    """
    value = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(NONE))
    keyed = docs.withColumns({
        "__topic": F.coalesce(topic if topic is not None else topic_of(text_column), F.lit(NONE)),
        "__n_tokens": tokens if tokens is not None else n_tokens(text_column), "__source": value(source_column),
        "__lang": value(lang_column),
    })
    by = [F.col(f"__{name}").alias(name) for name in ("source", "lang", "topic")]
    cells = written(keyed.groupBy(*by).agg(F.sum("__n_tokens").alias("tokens")), "mix-cells")
    if targets is None:
        targets = {name: flattened(cells, name, power) for name in ("source", "lang", "topic")}
    if budget is not None:
        budget *= float(cells.agg(F.sum("tokens")).first()[0] or 0)
    raked = written(rake(cells, targets, rounds, budget=budget), "mix-factors")
    tokens, largest, kept = raked.agg(
        F.sum("tokens"), F.max("factor"), F.sum(F.col("tokens") * F.col("factor"))
    ).first()
    scale, largest = float(tokens or 0), float(largest or 0) or 1.0
    if budget is not None:
        scale, largest = scale / (kept or 1.0), 1.0
    found = raked.select(
        *[F.col(name).alias(f"__{name}") for name in ("source", "lang", "topic")],
        (F.col("factor") * scale).alias("__weight"),
        (F.col("factor") / largest).alias("__probability"),
    )
    out = keyed.join(found, ["__source", "__lang", "__topic"], "left")
    out = out.withColumn("__sampled", uniform(id_column, seed) < F.col("__probability"))
    return out.select(*docs.columns, *[f"__{name}" for name in ADDED])
