"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much
of its text goes as a whole.

Defined results: a null text is an empty one and is rejected (no words); a row with a null id is
treated like any other; equal rows get equal results; an empty table gives an empty table; texts of
any length are read whole; columns that clash with the added ones are left out of the figures.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import SPACE, map_arrow, text_bytes, windows_of, words_of

SYMBOLS = b"#*$%&|<>"

#: The same kinds of phrases in German, French and Spanish.
PHRASES = (
    "alle rechte vorbehalten", "datenschutz", "datenschutzerklärung", "datenschutzrichtlinie",
    "impressum", "nutzungsbedingungen", "allgemeine geschäftsbedingungen", "agb",
    "cookies akzeptieren", "alle cookies akzeptieren", "cookie-richtlinie", "verwendung von cookies",
    "hier klicken", "klicken sie hier", "klick hier", "mehr lesen", "mehr erfahren", "weiterlesen",
    "jetzt anmelden", "anmelden", "einloggen", "registrieren", "newsletter abonnieren",
    "jetzt abonnieren", "teilen auf", "nach oben", "zum seitenanfang", "zum inhalt springen",
    "lizenziert unter", "veröffentlicht unter", "unter der lizenz",
    "tous droits réservés", "mentions légales", "politique de confidentialité",
    "politique de cookies", "politique relative aux cookies", "conditions d'utilisation",
    "conditions générales", "conditions générales d'utilisation", "accepter les cookies",
    "accepter tous les cookies", "cliquez ici", "lire la suite", "en savoir plus", "se connecter",
    "connectez-vous", "s'inscrire", "inscrivez-vous", "s'abonner", "abonnez-vous", "partager sur",
    "retour en haut", "haut de page", "aller au contenu", "sous licence", "publié sous",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "aviso legal",
    "términos de uso", "términos de servicio", "términos y condiciones", "aceptar cookies",
    "aceptar las cookies", "aceptar todas las cookies", "haga clic aquí", "haz clic aquí",
    "leer más", "ver más", "saber más", "iniciar sesión", "inicia sesión", "regístrate",
    "registrarse", "suscríbete", "suscribirse", "compartir en", "volver arriba", "ir al contenido",
    "saltar al contenido", "bajo licencia", "bajo la licencia", "publicado bajo",
)

#: Phrases between word boundaries, notices of licence and copyright with the name that they give.
BOILERPLATE = re.compile(
    rb"(?<![\w\x80-\xff])(?:all rights reserved"
    rb"|(?:(?:this|the)(?: [\w-]+){0,3} (?:is|are) )?(?:licensed|released|distributed) under "
    rb"(?:(?:[^.]|\.\d){0,80}?\b(?:licen[cs]e|l?gpl|public domain)(?:,? (?:version |v)?\d[\d.]*)?"
    rb"|cc[ -](?:by|0)[\w-]*(?: \d[\d.]*)?)"
    rb"|licensed under|released under the|is licensed|terms of (?:use|service)"
    rb"|privacy policy|cookie policy|use of cookies|accept (?:all )?cookies"
    rb"|copyright (?:\(c\)|\xc2\xa9|\d{4})[^.]{0,60}"
    rb"|sign (?:in|up)|log ?in|subscribe (?:now|to)|read more|click here"
    rb"|share (?:on(?: (?:facebook|twitter|x|linkedin|whatsapp|reddit|pinterest))?"
    rb"|this(?: (?:page|post|article|story|link))?)"
    rb"|skip to (?:main )?content|back to top|javascript (?:is|must)|"
    + b"|".join(re.escape(x.encode()) for x in sorted(PHRASES, key=len, reverse=True))
    + rb")(?![\w\x80-\xff])",
)
_WORDS = re.compile(rb"[\w\x80-\xff]+")
#: Words that go with such phrases and do not make prose of them.
FILLERS = frozenset(
    b"please to our the a here now or and your you for of by with this about account newsletter today "
    b"continue enabled be required".split()
    + "bitte hier sie zu um zur zum der die das den und oder ihr ihre jetzt auf unter mit für diese "
    "diesen seite facebook twitter veuillez pour le la les de du des et ou votre vos maintenant sur "
    "cette ce page notre por favor para el los las del y o su tu ahora en esta este página nuestro "
    "nuestra".encode().split()
)
NAVIGATION = re.compile(rb"\s(?:\||\xc2\xbb|\xe2\x80\xba|\xc2\xb7|>|/)\s")
#: Sentence ends of scripts that put a space after them, of those that do not, and closing marks.
_ENDS = "… । ॥ ؟ ۔ ؛ ։ ። ፧ ။ ។ ། ‼ ⁇ ⁈ ⁉"
_WIDE_ENDS = "。 ． ｡ ！ ？ ： ；"
_CLOSERS = "» › ” ’ “ ‘ « ‹ ″ ） 」 』 】 》 〉 ］ ＂ ＇"


def _any_of(marks: str) -> bytes:
    return b"|".join(re.escape(x.encode()) for x in marks.split())


SENTENCE_END = re.compile(
    rb"(?:[.!?:;]|" + _any_of(_ENDS) + rb")(?:[\"')\]}*_]|" + _any_of(_CLOSERS) + rb")*"
    rb"(?:\s|\xc2\xa0|$)|" + _any_of(_WIDE_ENDS) + rb"|\xc2\xbb\s*$"
)


@dataclass(frozen=True)
class LineRules:
    """When a line fails, and how much of a document may go."""

    #: Symbols per word.
    max_symbols: float = 0.3
    #: Separators between cells or links, per word.
    max_separators: float = 0.25
    #: A line of at least ``long_line`` words fails if it has fewer distinct words per word.
    min_distinct: float = 0.3
    long_line: int = 12
    #: Share of words that end in an exclamation mark.
    max_shouted: float = 0.5
    #: A line of boilerplate phrases and little else fails up to this many words.
    max_boilerplate_words: int = 30
    #: Words besides the phrases and their fillers, per word of the phrases.
    max_besides: float = 0.5
    #: A line needs the end of a sentence somewhere, unless it starts the text and has fewer words.
    heading: int = 12
    #: A document is rejected when it keeps a smaller share of its word characters.
    min_kept: float = 0.5
    #: The base rules, on the whole text.
    min_words: int = 10
    max_repeated_percent: int = 20


DEFAULT = LineRules()


def _besides(lowered: bytes) -> float:
    """Words outside the phrases of boilerplate for each word in them."""
    inside = sum(len(_WORDS.findall(m[0])) for m in BOILERPLATE.finditer(lowered))
    rest = _WORDS.findall(BOILERPLATE.sub(b" ", lowered))
    return sum(w not in FILLERS for w in rest) / max(inside, 1)


def line_fails(line: bytes, words: list[bytes], first: bool, rules: LineRules) -> str | None:
    """The rule that a line with words fails, or None."""
    n = len(words)
    lowered = line.lower()
    if n <= rules.max_boilerplate_words and BOILERPLATE.search(lowered):
        if _besides(lowered) <= rules.max_besides:
            return "boilerplate"
    separators = len(NAVIGATION.findall(b" " + line + b" "))
    if separators >= 3 and separators > rules.max_separators * n:
        return "navigation"
    if n and len(line) - len(line.translate(None, SYMBOLS)) > rules.max_symbols * n + 1:
        return "symbols"
    if n >= rules.long_line:
        if len(set(words)) < rules.min_distinct * n:
            return "repetition"
        if sum(w.endswith(b"!") for w in words) > rules.max_shouted * n:
            return "shouting"
    if not SENTENCE_END.search(line) and not (first and n < rules.heading):
        return "punctuation"
    return None


def judge(data: bytes, rules: LineRules = DEFAULT) -> dict:
    """Figures, kept text and verdict of one text."""
    codes = np.frombuffer(data, dtype=np.uint8)
    starts, ends, hashes = words_of(data)
    n_words = len(starts)
    characters = np.concatenate(([0], np.cumsum(((codes & 0xC0) != 0x80) & ~SPACE[codes])))
    word_chars = int(characters[-1])
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))

    windows = windows_of(hashes, 5)
    n_repeated = 0
    if len(windows):
        order = np.argsort(windows, kind="stable")
        equal = windows[order[1:]] == windows[order[:-1]]
        twice = np.zeros(len(windows), dtype=bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        change = np.zeros(n_words + 1, dtype=np.int64)
        found = np.flatnonzero(twice)
        change[found] += 1
        change[found + 5] -= 1
        n_repeated = int((np.cumsum(change)[:n_words] > 0).sum())

    seen: set[bytes] = set()
    n_duplicate = n_failed = kept_chars = at = 0
    kept, any_words = [], False
    failed: dict[str, int] = {}
    for line in data.split(b"\n"):
        start, at = at, at + len(line) + 1
        words = line.split()
        if not words:
            kept.append(line)
            continue
        if line in seen:
            n_duplicate += 1
        seen.add(line)
        rule = line_fails(line, words, not any_words, rules)
        any_words = True
        if rule is None:
            kept.append(line)
            kept_chars += int(characters[start + len(line)] - characters[start])
        else:
            n_failed += 1
            failed[rule] = failed.get(rule, 0) + 1
    body = b"\n".join(kept)
    base_failed = (
        n_words < rules.min_words or 100 * n_repeated > rules.max_repeated_percent * n_words
    )
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
        "n_dup_lines": n_duplicate, "n_repeat_words": n_repeated, "base_failed": base_failed,
        "kept": not base_failed and kept_chars > 0 and kept_chars >= rules.min_kept * word_chars,
        "n_lines_removed": n_failed, "kept_chars": kept_chars,
        "failed_rules": ",".join(f"{k}:{failed[k]}" for k in sorted(failed)),
        "clean_text": body,
    }


FIGURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines_removed long, kept_chars long, "
    "failed_rules string"
)
_TYPES = {
    "base_failed": pa.bool_(), "kept": pa.bool_(), "failed_rules": pa.string(),
    "clean_text": pa.string(),
}


def judged(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    rules: LineRules = DEFAULT, with_text: bool = False,
) -> DataFrame:
    """One row a document: its id, the figures, the verdict and, if asked for, the cleaned text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> dict:
        found = [judge(x.as_py(), rules) for x in batch.column(1)]
        names = [x.split()[0] for x in FIGURES.split(", ")] + ["clean_text"] * with_text
        return {id_column: batch.column(0)} | {
            k: pa.array([x[k] for x in found], _TYPES.get(k, pa.int64())) if k != "clean_text"
            else pa.array([x[k].decode("utf-8", "replace") for x in found], pa.string())
            for k in names
        }

    slim = docs.select(F.col(id_column), text_bytes(text_column).alias("data"))
    return map_arrow(
        slim, rows, f"`{id_column}` {kind}, {FIGURES}" + ", clean_text string" * with_text
    )


def clean_documents(
    docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars",
    rules: LineRules = DEFAULT,
) -> DataFrame:
    """The documents that pass, with their columns, their failing lines taken out of the text.

    A length column, if the table has one, follows the new text.
    """
    names = docs.columns
    at = names.index(text_column)

    def rows(batch: pa.RecordBatch) -> dict:
        found = [judge(x.as_py(), rules) for x in batch.column(len(names))]
        keep = pa.array([x["kept"] for x in found], pa.bool_())
        texts = [x["clean_text"].decode("utf-8", "replace") for x in found if x["kept"]]
        columns = {f"_{i}": batch.column(i).filter(keep) for i in range(len(names))}
        return columns | {f"_{at}": pa.array(texts, pa.string())}

    schema = ", ".join(f"`_{i}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    slim = docs.toDF(*[f"_{i}" for i in range(len(names))])
    slim = slim.withColumn("data", text_bytes(f"_{at}"))

    out = map_arrow(slim, rows, schema).toDF(*names)
    if length_column in names:
        out = out.withColumn(
            length_column,
            F.length(text_column).cast(docs.schema[length_column].dataType),
        )
    return out
