"""The pipeline and the registered queries, against brute force and SQL."""

import hashlib
import random
from collections import Counter

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
import corpus_pipeline
from reelstat.llm import queries

NAMES = [f"op{n}_" for n in range(1, 14)]


def test_each_operator_has_one_query():
    for name in NAMES:
        assert sum(x.startswith(name) for x in queries.QUERIES) == 1
    registered = entry_file.queries()
    assert {*queries.QUERIES, "pipeline"} <= registered.keys()
    assert {*queries.ORACLES} <= entry_file.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf_dir, name):
    frame = queries.QUERIES[name](spark, sf_dir)
    con = compare.connect(sf_dir)
    assert compare.spark_types(frame) == compare.sql_types(con, queries.ORACLES[name])
    assert compare.spark_rows(frame) == compare.sql_rows(con, queries.ORACLES[name])


@pytest.mark.parametrize("name", ["op2_html_text", "op4_pii_surrogates", "op6_decontaminate"])
def test_queries_give_rows(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0


def corpus(spark, folder, n=260):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    sentence = lambda: " ".join(rng.choices(words, k=rng.randint(6, 14))) + "."
    leak = " ".join(rng.choices([f"b{i}" for i in range(200)], k=30))
    rows, made = [], []
    for i in range(n):
        kind = rng.random()
        if made and kind < 0.2:
            text = rng.choice(made)
            if rng.random() < 0.5:
                text += "\nAll rights reserved."
        elif kind < 0.3:
            text = " ".join(f"{rng.choice(words)}###" for _ in range(30))
        else:
            text = "\n".join(sentence() for _ in range(rng.randint(2, 6)))
            if kind < 0.4:
                text += f"\n{leak}."
            made.append(text)
        rows.append((i, text, rng.choice(["en", "de"]), f"src{min(rng.randrange(6), 3)}", len(text)))
    path = folder("sf")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, leak


def plain_rules(text):
    """The text that the line rules leave of a text of this corpus, or None if it goes. Its lines hold
    words, sentence ends, # and one notice."""
    words = text.split()
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    repeated = {
        k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)
    }
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return None
    kept, chars = [], 0
    for number, line in enumerate(text.split("\n")):
        own = line.split()
        notice = line == "All rights reserved."
        symbols = line.count("#") > 0.3 * len(own) + 1
        ended = any(w[-1] in ".!?:;" for w in own) or (number == 0 and len(own) < 12)
        repetitive = len(own) >= 12 and len(set(own)) < 0.3 * len(own)
        if not own or (ended and not notice and not symbols and not repetitive):
            kept.append(line)
            chars += len("".join(own))
    return "\n".join(kept) if chars and chars >= 0.5 * len("".join(words)) else None


def plain_leak(text, leak):
    """Whether some offset has a stretch with enough equal words: +1 for each, -1 for a different one."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    item = leak.split()
    for offset in range(-len(item) + 1, len(words)):
        equal = [0 <= i + offset < len(words) and words[i + offset] == w for i, w in enumerate(item)]
        score = top = count = best = 0
        for x in equal:
            score, count = (score + (1 if x else -1), count + x)
            if score <= 0:
                score = count = 0
            if score >= top:
                top, best = score, max(best, count) if score == top else count
        if best >= min(12, max(-(-6 * len(item) // 10), 6)):
            return True
    return False


def plain_rake(tokens, budget, power=0.7, rounds=400):
    """Probabilities by cell {(source, lang): tokens}: each dimension in turn meets its shares of the
    budget, by bisection, with no probability above 1."""
    cells = list(tokens)
    t = np.array([float(tokens[c]) for c in cells])
    goal = []
    for d in range(2):
        held = {}
        for c, x in zip(cells, t):
            held[c[d]] = held.get(c[d], 0.0) + x
        share = {k: v**power for k, v in held.items()}
        low, high = 0.0, 1e12
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(held[k], mid * v) for k, v in share.items()) < budget else (low, mid)
        goal.append({k: min(held[k], high * v) for k, v in share.items()})
    raw = np.ones(len(cells))
    for _ in range(rounds):
        for d in range(2):
            for value, wanted in goal[d].items():
                at = np.array([c[d] == value for c in cells])
                low, high = 0.0, 1e9
                for _ in range(80):
                    mid = (low + high) / 2
                    low, high = (mid, high) if (np.minimum(raw[at] * mid, 1) * t[at]).sum() < wanted else (low, mid)
                raw[at] *= (low + high) / 2
    return dict(zip(cells, np.minimum(raw, 1)))


def test_every_stage_equals_brute_force(spark, folder):
    path, rows, leak = corpus(spark, folder)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, states = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        docs.write.parquet(out := folder("stage"))
        docs = spark.read.parquet(out)
        states.append({r["doc_id"]: r for r in docs.collect()})

    cleaned = {i: plain_rules(text) for i, text, *_ in rows}
    cleaned = {i: text for i, text in cleaned.items() if text is not None}
    assert {i: r["text"] for i, r in states[0].items()} == cleaned
    assert 0 < len(cleaned) < len(rows)

    sets = {}
    for i, text in cleaned.items():
        w = text.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    parent = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = i, j
                while parent[a] != a:
                    a = parent[a]
                while parent[b] != b:
                    b = parent[b]
                parent[max(a, b)] = min(a, b)
    firsts = {i for i in parent if parent[i] == i}
    assert states[1].keys() == firsts and len(firsts) < len(cleaned)

    clean = {i for i in firsts if not plain_leak(cleaned[i], leak)}
    assert states[2].keys() == clean and len(clean) < len(firsts)

    cell = {i: (r["source"], r["lang"]) for i, r in states[2].items()}
    tokens = Counter()
    for i in clean:
        tokens[cell[i]] += len(cleaned[i].split())
    chance = plain_rake(tokens, corpus_pipeline.KEPT * sum(tokens.values()))
    drawn = {i: int(hashlib.md5(f"{i}mix".encode()).hexdigest()[:8], 16) / 2**32 for i in clean}
    close = {i for i in clean if abs(drawn[i] - chance[cell[i]]) < 1e-5}
    assert len(close) < 3
    assert states[3].keys() - close == {i for i in clean if drawn[i] < chance[cell[i]]} - close
    assert all(states[3][i] == states[2][i] for i in states[3])

    assert states[4].keys() == states[3].keys()
    shards, sizes = {}, {}
    for i, r in states[4].items():
        shards.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + len(cleaned[i].encode()) + 16
        assert r["text"] == cleaned[i]
    assert all(sorted(x) == list(range(len(x))) for x in shards.values())
    assert all(0 <= k < corpus_pipeline.N_SHARDS for k in shards)
    largest = max(len(cleaned[i].encode()) + 16 for i in states[4])
    mean = sum(sizes.values()) / corpus_pipeline.N_SHARDS
    assert all(abs(sizes.get(k, 0) - mean) <= largest for k in range(corpus_pipeline.N_SHARDS))


def test_run_gives_the_columns_of_documents_and_the_shard(spark, folder):
    path, _, _ = corpus(spark, folder, n=60)
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert out.count() > 0


def test_run_on_an_empty_table(spark, folder):
    path, _, _ = corpus(spark, folder, n=5)
    empty = folder("empty")
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_nulls_and_repeated_rows_pass_through(spark, folder):
    path, _, _ = corpus(spark, folder, n=40)
    odd = folder("odd")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    nothing = docs.select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    unnamed = docs.limit(3).withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes if c != "text"})
    docs.unionAll(docs).unionAll(nothing).unionAll(unnamed).write.parquet(f"{odd}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{odd}/benchmark.parquet")
    out = corpus_pipeline.run(spark, odd).collect()
    once = {r["doc_id"] for r in corpus_pipeline.run(spark, path).collect()}
    found = Counter(r["doc_id"] for r in out if r["doc_id"] is not None)
    # Equal rows stay or go together, and texts are as the documents have them.
    assert found and set(found.values()) == {2} and len(found.keys() & once) > 0.5 * len(once)
    assert all(r["text"] is not None for r in out)
