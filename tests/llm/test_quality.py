import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

import pytest

from reelstat.llm import quality

PROSE = "The quick brown fox jumps over the lazy dog while seven wizards watch from afar."


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    repeated = set()
    for k in range(len(words) - 4):
        if runs[tuple(words[k : k + 5])] > 1:
            repeated |= set(range(k, k + 5))
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates,
        len(repeated), failed,
    )


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t ß|#. \x00"), max_size=120))
def test_figures_equal_brute_force(text):
    found = quality.judge(text.encode())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert tuple(found[x] for x in names) == brute(text)


def test_each_rule_takes_its_lines():
    lines = {
        "boilerplate": "All rights reserved.",
        "navigation": "Home | About | News | Contact | Help",
        "symbols": "one### two*** three$$$ four%%% five&&&.",
        "repetition": "buy buy buy buy buy buy buy buy buy buy buy buy buy now.",
        "shouting": " ".join(f"WORD{i}!!" for i in range(14)),
        "punctuation": "a line without any end that goes on for a while",
    }
    body = f"{PROSE} " + " ".join(f"word{i}" for i in range(80)) + "."
    for rule, line in lines.items():
        found = quality.judge(f"{body}\n{line}".encode())
        assert found["failed_rules"] == f"{rule}:1", rule
        assert found["clean_text"].decode() == body
        assert found["kept"]


def test_a_document_that_loses_too_much_goes():
    bad = "\n".join(f"x{i}### y{i}*** z{i}$$$ w{i}%%%" for i in range(40))
    assert not quality.judge(f"{PROSE}\n{bad}".encode())["kept"]


def test_clean_documents_keep_their_columns_and_lose_lines(docs):
    table = docs(PROSE, f"{PROSE}\nAll rights reserved.", "too short", None, "")
    rows = {r["doc_id"]: r for r in quality.clean_documents(table).collect()}
    assert sorted(rows) == [0, 1]
    assert rows[1]["text"] == PROSE and rows[1]["n_chars"] == len(PROSE)
    assert rows[1]["source"] == "src1"


def test_nulls_repeats_clashes_and_empty_tables(frame):
    rows = [(None, PROSE, 1), (None, None, None), (2, PROSE, 5), (2, PROSE, 5)]
    table = frame("doc_id long, text string, n_words int", rows)
    found = sorted((r["n_words"], r["kept"]) for r in quality.judged(table).collect())
    assert found == [(0, False), (15, True), (15, True), (15, True)]
    assert quality.judged(table.limit(0)).count() == 0
    kept = quality.clean_documents(table)
    assert kept.columns == table.columns and kept.count() == 3


def test_a_very_long_text(docs):
    long = " ".join(f"word{i}" for i in range(300_000)) + "."
    row = quality.judged(docs(long)).first()
    assert (row["n_words"], row["kept"]) == (300_000, True)


def fails(line):
    return quality.line_fails(line.encode(), line.encode().split(), False, quality.DEFAULT)


def test_sentence_ends_of_all_scripts_and_closing_quotes():
    body = "one two three four five six seven eight nine ten eleven twelve"
    for start, end in [
        ("“", ".”"), ("‘", "!’"), ("„", ".“"), ("»", ".«"), ("", "।"), ("", "؟"), ("", "！"), ("「", "？」"),
        ("", "。"), ("", "…”"), ("", "۔"), ("(", ".)"), ("«", " !»"),
    ]:
        assert fails(f"{start}{body}{end}") is None, end
        assert quality.judge(f"{start}{body}{end}".encode())["kept"]
    assert fails(f"“{body}”") == "punctuation"


def test_ordinary_phrases_are_no_boilerplate():
    for line in (
        "The design in question was never built.", "The catalog in the hall is old.",
        "She spent the day cataloging books.", "And is erer. Ereaes oftheshare onstor.",
        "Every visitor must sign in at the desk before going upstairs.",
        "He was released under the condition that he left the town.",
        "They read more books in winter than in summer.",
    ):
        assert fails(line) is None, line
    for line in (
        "All rights reserved.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0.", "Please log in to continue.", "Read more »",
        "Copyright 2024 The Example Authors. All rights reserved.", "Sign up for our newsletter today!",
        "Share on Facebook", "Privacy policy and terms of use.",
    ):
        assert fails(line) == "boilerplate", line


@pytest.mark.parametrize("line", [
    "Alle Rechte vorbehalten. Datenschutz. Impressum.", "Bitte hier klicken.", "Weiterlesen!",
    "Jetzt anmelden oder registrieren.", "Tous droits réservés.", "Cliquez ici pour lire la suite.",
    "Mentions légales. Politique de confidentialité.", "S'abonner.", "Haga clic aquí.",
    "Todos los derechos reservados. Aviso legal.", "Iniciar sesión o registrarse.", "Click here.",
])
def test_boilerplate_of_four_languages_fails(line):
    data = line.encode()
    assert quality.line_fails(data, data.split(), False, quality.DEFAULT) == "boilerplate"


@pytest.mark.parametrize("line", [
    "Der Datenschutz war im Parlament lange umstritten, und niemand wollte nachgeben.",
    "Sie konnte sich nicht anmelden, weil der Rechner am Morgen ausgefallen war.",
    "La conexión falló antes de iniciar sesión en el sistema del hospital.",
    "Il voulait en savoir plus sur la vie des oiseaux de la montagne.",
])
def test_prose_with_such_words_passes(line):
    data = line.encode()
    assert quality.line_fails(data, data.split(), False, quality.DEFAULT) is None
