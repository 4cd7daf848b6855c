import itertools

import numpy as np
import pytest

import corpus_pipeline
from reelstat.llm import mixing


def brute(cells, goals, rounds=300):
    """Raking in numpy: cells {(source, lang, topic): tokens}, goals by dimension."""
    keys = [k for k, t in cells.items() if t > 0 and all(goals[d].get(k[d], 0) > 0 for d in range(3))]
    w = np.array([float(cells[k]) for k in keys])
    for _ in range(rounds):
        for d in range(3):
            present = {k[d] for k in keys}
            total = sum(goals[d][v] for v in present)
            for v in present:
                at = np.array([k[d] == v for k in keys])
                w[at] *= goals[d][v] / total / w[at].sum()
    return {k: x / cells[k] for k, x in zip(keys, w)}


@pytest.fixture
def cells(frame):
    def make(table):
        rows = [(*k, t) for k, t in table.items()]
        return frame("source string, lang string, topic string, tokens long", rows)

    return make


def targets(frame, goals):
    return {
        name: frame("value string, share double", list(goal.items()))
        for name, goal in zip(("source", "lang", "topic"), goals)
    }


def test_raking_equals_brute_force_and_meets_the_targets(frame, cells):
    rng = np.random.default_rng(3)
    table = {
        k: int(rng.integers(1, 500)) for k in itertools.product("abcd", ["en", "de"], ["x", "y", "z"])
        if rng.random() < 0.9
    }
    goals = [{"a": 4.0, "b": 1.0, "c": 1.0, "d": 2.0}, {"en": 0.6, "de": 0.4}, {"x": 0.2, "y": 0.3, "z": 0.5}]
    found = {
        (r[0], r[1], r[2]): r[4] for r in mixing.rake(cells(table), targets(frame, goals)).collect()
    }
    expected = brute(table, goals)
    assert found.keys() == table.keys()
    for k, factor in expected.items():
        assert found[k] == pytest.approx(factor, rel=1e-8)
    for d, goal in enumerate(goals):
        for value, share in goal.items():
            got = sum(table[k] * x for k, x in found.items() if k[d] == value)
            assert got == pytest.approx(share / sum(goal.values()), rel=1e-8)


def test_missing_targets_and_cells_without_tokens(frame, cells):
    table = {("a", "en", "x"): 10, ("b", "en", "x"): 0, ("c", "en", "x"): 10, ("a", "de", "x"): 5}
    goals = [{"a": 1.0, "b": 1.0}, {"en": 1.0, "fr": 1.0}, {"x": 1.0}]
    rows = mixing.rake(cells(table), targets(frame, goals)).collect()
    found = {(r[0], r[1]): r[4] for r in rows}
    assert found == {("a", "en"): pytest.approx(0.1), ("b", "en"): 0, ("c", "en"): 0, ("a", "de"): 0}


def test_probabilities_follow_the_weights(docs):
    table = docs(*["one two three four"] * 60, *["mail me@x.org now"] * 6)
    rows = mixing.mixed(table, power=0.0).collect()
    by_topic = {r["topic"]: r for r in rows}
    assert by_topic.keys() == {"prose", "contact"}
    assert max(r["probability"] for r in rows) == pytest.approx(1.0)
    expected = {}
    for r in rows:
        expected[r["topic"]] = expected.get(r["topic"], 0) + r["n_tokens"] * r["probability"]
    assert expected["prose"] == pytest.approx(expected["contact"])
    assert sum(r["sampled"] for r in rows if r["topic"] == "contact") == 6
    kept = mixing.mix(table, power=0.0)
    assert kept.columns == table.columns
    assert kept.count() == sum(r["sampled"] for r in rows)


def test_edges(frame):
    rows = [(1, "a b", None, None, 3), (1, "a b", None, None, 3), (None, None, "en", "s", 1), (4, "", "en", "s", 2)]
    table = frame("doc_id long, text string, lang string, source string, topic int", rows)
    out = mixing.mixed(table)
    assert out.columns == ["doc_id", "text", "lang", "source", *mixing.ADDED]
    found = {(r["doc_id"], r["n_tokens"], r["probability"]) for r in out.collect()}
    assert found == {(1, 2, 1.0), (None, 0, 0.0), (4, 0, 0.0)}
    assert out.count() == 4
    assert mixing.mix(table).columns == table.columns
    assert mixing.mixed(table.limit(0)).count() == 0
    blank = table.filter("n IS NULL" if "n" in table.columns else "text = ''")
    assert [r["sampled"] for r in mixing.mixed(blank).collect()] == [False]


def test_main_path_runs_no_python(docs):
    plan = mixing.mixed(docs("a b c", "d"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_budget_is_met_without_probabilities_over_1(frame, cells):
    rng = np.random.default_rng(4)
    table = {k: int(rng.integers(50, 500)) for k in itertools.product("abcd", ["en", "de"], ["x", "y", "z"])}
    table["d", "de", "z"] = 1
    goals = [{"a": 4.0, "b": 1.0, "c": 1.0, "d": 2.0}, {"en": 0.6, "de": 0.4}, {"x": 0.2, "y": 0.3, "z": 0.5}]
    for share in (0.3, 0.45, 1.0, 2.0):
        budget = share * sum(table.values())
        rows = mixing.rake(cells(table), targets(frame, goals), rounds=200, budget=budget).collect()
        found = {(r[0], r[1], r[2]): r[4] for r in rows}
        assert all(0 <= x <= 1 for x in found.values())
        kept = sum(table[k] * x for k, x in found.items())
        assert kept == pytest.approx(min(budget, sum(table.values())))
        for d, goal in enumerate(goals):
            held = {v: sum(t for k, t in table.items() if k[d] == v) for v in goal}
            wanted = mixing._bounded(goal, held, kept)
            for value in goal:
                got = sum(table[k] * x for k, x in found.items() if k[d] == value)
                assert got == pytest.approx(wanted[value], rel=1e-5), (share, value)
        # Below 1 a factor is the product of one for each source, language and topic.
        if share == 0.3:
            for s, t in itertools.combinations("abcd", 2):
                both = [found[s, "en", "x"], found[t, "de", "x"], found[s, "de", "x"], found[t, "en", "x"]]
                if max(both) < 1:
                    assert both[0] * both[1] == pytest.approx(both[2] * both[3])


def test_a_rare_cell_does_not_decide_how_much_the_pipeline_keeps(spark, docs):
    table = docs(*["one two three four five"] * 900, *["mail me@x.org now"] * 3, "licensed under x")
    expected = mixing.mixed(table, budget=corpus_pipeline.KEPT).selectExpr(
        "sum(n_tokens * probability) / sum(n_tokens)", "max(probability)"
    ).first()
    assert expected[0] == pytest.approx(corpus_pipeline.KEPT) and expected[1] == 1.0
    stage = dict(corpus_pipeline.STAGES)["mixing sources to target weights"]
    assert 0.5 < stage(spark, table, "").count() / 904 < 0.7


def test_draws_equal_the_documents_with_their_texts(docs):
    table = docs(*["one two three four"] * 30, *["mail me@x.org now"] * 6, None, "", "w " * 300_000)
    table = table.withColumn("n_tokens", table.doc_id * 0)
    names = ["doc_id", "source", "lang", *mixing.ADDED]
    for options in ({}, {"power": 0.0}, {"budget": 0.5}):
        whole = mixing.mixed(table, **options).select(*names).collect()
        slim = mixing.draws(table, **options)
        assert sorted(slim.columns) == sorted(names)
        assert sorted(slim.select(*names).collect()) == sorted(whole)
    assert mixing.draws(table.limit(0)).count() == 0
