"""Personal data in whole texts, with offset-preserving deobfuscation.

Plain identifiers (e-mail, IPv4, payment card, phone) are found in the text as it stands. Then three transducers
(homoglyphs and invisible characters; spelled digits; at/dot disguises) rewrite the text while every output character
keeps the source span it came from; identifiers found in the rewritten text are mapped back to source characters and
added; an added span may enclose a plain one but never cuts it. Offsets are code points, ends exclusive.

Null and empty texts give no spans; repeated rows each get a row; columns other than the named ones are ignored.
All scans are linear in the text, so one very long text costs no more than many short ones. Tables may be empty; columns
may have any name.

Coverage: look-alikes of Cyrillic, Greek, Armenian and Cherokee by table, and by rule whatever Unicode relates to an ASCII
character (compatibility forms such as full-width, mathematical, circled and superscript ones; digits, dashes and blanks of any
script; letters named Latin); format characters and variation selectors are invisible. Digits and ten to nineteen are
spelled in English, German, French and Spanish, also doubled or tripled.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textkit import Chunk, map_text

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only: a match from its middle exists only if one from its start does.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")

# Letters of other scripts that look like Latin ones or digits. What Unicode itself relates to a Latin
# letter, digit, dash or space (by compatibility, category or name) is found by rule, in ``_plain_letter``.
CONFUSABLE = {
    **dict(zip("аеорсухіјѕԁһӏԛԝѵАВЕКМНОРСТХІЈЅУԚԜѴ", "aeopcyxijsdhlqwvABEKMHOPCTXIJSYQWV", strict=True)),  # Cyrillic
    **dict(zip("αοινρυκτχϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "aoivpuktxcjABEZHIKMNOPTYXCJ", strict=True)),  # Greek
    **dict(zip("օոսհցքզյՕՍԼՏ", "onuhgpqjOULS", strict=True)),  # Armenian
    **dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᏀᏂᏃᏎᏏᏢᏟᏞᏚᏙᏦᏧᏴ", "DRTiYAJEWMHGhZ4bPCLSVKdB", strict=True)),  # Cherokee
    **dict(zip("。·‧∙", "....", strict=True)),
}
# Digit words of the corpus languages, ten to nineteen, and words that say a digit several times.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "ten": "10", "eleven": "11", "twelve": "12", "thirteen": "13", "fourteen": "14", "fifteen": "15", "sixteen": "16", "seventeen": "17", "eighteen": "18", "nineteen": "19",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zehn": "10", "elf": "11", "zwölf": "12", "dreizehn": "13", "vierzehn": "14", "fünfzehn": "15", "sechzehn": "16", "siebzehn": "17", "achtzehn": "18", "neunzehn": "19",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "dix": "10", "onze": "11", "douze": "12", "treize": "13", "quatorze": "14", "quinze": "15", "seize": "16",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "diez": "10", "once": "11", "doce": "12", "trece": "13", "catorce": "14", "quince": "15",
}
TIMES_WORDS = {"double": 2, "doppelt": 2, "doble": 2, "triple": 3, "dreifach": 3}
DOT_WORDS = ("dot", "punkt", "point", "punto")
AT_WORDS = ("at", "arroba", "arobase", "chez")

_word = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_dot, _at, _times = "|".join(DOT_WORDS), "|".join(AT_WORDS), "|".join(TIMES_WORDS)
_unit = rf"(?:(?:{_times})[ \t-]{{1,2}})?(?:{_word})"
# What the transducers rewrite; the gate below is made of the same parts, without what must stand around them.
_ODD = r"[^\x00-\xac\xae-ɏ]|[²³¹]"
_GAP = rf"(?:[ \t,-]{{1,3}}|[ \t]{{1,2}}(?:{_dot})[ \t]{{1,2}})"
_OPEN, _CLOSE = r"[ \t]{0,2}[\[({<][ \t]{0,2}", r"[ \t]{0,2}[\])}>][ \t]{0,2}"
_DOT_SIGN = rf"(?:{_OPEN}(?:{_dot}|\.){_CLOSE}|[ \t]{{1,2}}(?:{_dot})[ \t]{{1,2}})"
_AT_SIGN = rf"(?:{_OPEN}(?:{_at}|@){_CLOSE}|[ \t]{{1,2}}@[ \t]{{0,2}}|@[ \t]{{1,2}})"
_SPELLED = re.compile(rf"(?i)(?<!\w)(?:plus[ \t-]+(?={_unit}(?!\w)))?{_unit}(?:{_GAP}{_unit})+(?!\w)")
_SPELLED_PART = re.compile(rf"(?i)(plus)|({_dot})|(?:({_times})[ \t-]{{1,2}})?({_word})")
_DOT = re.compile(rf"(?i)(?<=[A-Za-z0-9-]){_DOT_SIGN}(?=[A-Za-z0-9-])")
_AT = re.compile(rf"(?i)(?<=[A-Za-z0-9._%+-]){_AT_SIGN}(?=[A-Za-z0-9-])")
_BARE_AT = re.compile(rf"(?i)(?<=[A-Za-z0-9._%+-])[ \t]{{1,2}}(?:{_at})[ \t]{{1,2}}(?=[A-Za-z0-9-])")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")

#: RE2 patterns that say which texts need a closer look.
_MAY_BE_PLAIN = r"@|[0-9]"
# RE2 counts fewer letters as words' and as an i in any case than Python does. A bare ``at`` needs a changed host.
_SIGNS = rf"{_DOT_SIGN}|{_AT_SIGN}|(?:^|[^0-9A-Za-z_])(?:{_word}){_GAP}{_unit}(?:[^0-9A-Za-z_]|$)"
_MAY_BE_HIDDEN = rf"{_ODD}|(?i:{_SIGNS.replace('i', '[iıİ]')})"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of identifiers as they stand, leftmost and without overlap within a kind."""
    out, free, p = [], 0, text.find("@")
    while p >= 0:
        s = p
        while s > free and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, p + 1) if s < p else None
        if m:
            free = m.end()
            out.append((s, 0, free))
            p = text.find("@", free)
        else:
            p = text.find("@", p + 1)
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0]) if m.end() - m.start() < 64 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    p = text.find("+")
    if p >= 0:
        for m in _PHONE.finditer(text, p):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


class Tape:
    """A rewritten text whose every character knows its source span and whether it was changed."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.changed = np.zeros(len(text), bool)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace [a, z) by the string, for sorted edits without overlap; each new character spans the whole source."""
        if not edits:
            return
        text, parts, at = [], [], 0
        for a, z, new in edits:
            text += (self.text[at:a], new)
            parts.append((self.start[at:a], self.end[at:a], self.changed[at:a]))
            n, s, e = len(new), (self.start[a], self.end[z - 1])[0], self.end[z - 1]
            parts.append((np.full(n, s), np.full(n, e), np.ones(n, bool)))
            at = z
        text.append(self.text[at:])
        parts.append((self.start[at:], self.end[at:], self.changed[at:]))
        self.text = "".join(text)
        self.start, self.end, self.changed = (np.concatenate(x) for x in zip(*parts, strict=True))


#: Letters that Unicode names Latin without relating them to plain ones: small capitals, script g, negative squares, flags.
_LATIN_NAME = re.compile(r"(?:LATIN|REGIONAL INDICATOR SYMBOL)( SMALL| CAPITAL|) LETTER (?:SMALL CAPITAL |SCRIPT |OPEN )?([A-Z])$")


def _plain_letter(c: str) -> str:
    """The plain character that ``c`` stands for, nothing if it is invisible, or ``c``."""
    if c in CONFUSABLE:
        return CONFUSABLE[c]
    kind, d = unicodedata.category(c), unicodedata.digit(c, None)
    if kind == "Cf" or "\ufe00" <= c <= "\ufe0f" or c == "\u034f":
        return ""
    if d is not None:
        return str(d)
    k = unicodedata.normalize("NFKC", c)
    if len(k) == 1 and k.isascii():
        return k
    if kind in ("Pd", "Zs"):
        return "-" if kind == "Pd" else " "
    m = _LATIN_NAME.search(unicodedata.name(c, ""))
    return (m[2] if "CAPITAL" in m[1] else m[2].lower()) if m else c


_known: dict[str, str] = {}


def homoglyphs(tape: Tape) -> None:
    edits = []
    if not tape.text.isascii():
        for m in re.finditer(_ODD, tape.text):
            c = m[0]
            if c not in _known:
                _known[c] = _plain_letter(c)
            if _known[c] != c:
                edits.append((m.start(), m.end(), _known[c]))
    tape.rewrite(edits)


def _fold_word(word: str) -> str:
    """Lower case, with the letters that patterns take for i and s in any case."""
    return word.replace("İ", "i").replace("ı", "i").replace("ſ", "s").lower()


def spelled_digits(tape: Tape) -> None:
    """Runs of two or more digit words become digits; ``plus`` before and dot words within a run become signs."""
    edits = []
    for m in _SPELLED.finditer(tape.text):
        at = m.start()
        for p in _SPELLED_PART.finditer(tape.text, m.start(), m.end()):
            new = "+" if p[1] else "." if p[2] else DIGIT_WORDS[_fold_word(p[4])] * (TIMES_WORDS[_fold_word(p[3])] if p[3] else 1)
            edits.append((at, p.end(), new))
            at = p.end()
    tape.rewrite(edits)


def at_and_dot(tape: Tape) -> None:
    """Bracketed or spaced at and dot signs; a bare ``at`` counts only before a host whose dot was disguised too."""
    tape.rewrite([(m.start(), m.end(), ".") for m in _DOT.finditer(tape.text)])
    edits = {m.start(): (m.start(), m.end(), "@") for m in _AT.finditer(tape.text) if _HOST.match(tape.text, m.end())}
    for m in _BARE_AT.finditer(tape.text):
        host = _HOST.match(tape.text, m.end())
        if host and tape.changed[host.start() : host.end()].any():
            edits.setdefault(m.start(), (m.start(), m.end(), "@"))
    tape.rewrite([edits[k] for k in sorted(edits)])


def hidden_spans(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Identifiers that show only after deobfuscation; one may enclose plain ones, but not cut them."""
    tape = Tape(text)
    for step in (homoglyphs, spelled_digits, at_and_dot):
        step(tape)
    if tape.text == text:
        return []
    # A span cuts another one, or lies in it, if one of its ends is inside that one.
    out, inside = [], np.zeros(len(text) + 1, bool)
    for x, _, y in plain:
        inside[x + 1 : y] = True
    for s, kind, e in plain_spans(tape.text):
        a, z = int(tape.start[s]), int(tape.end[e - 1])
        if text[a:z] != tape.text[s:e] and not inside[a] and not inside[z]:
            out.append((a, kind, z))
            inside[a + 1 : z] = True
    return sorted(out)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_spans(texts: pa.Array, chunk: Chunk) -> dict[int, tuple[list, list]]:
    """Row -> (plain spans, added spans), only for rows that have any."""
    plain = pc.match_substring_regex(texts, _MAY_BE_PLAIN).to_numpy(zero_copy_only=False)
    hidden = pc.match_substring_regex(texts, _MAY_BE_HIDDEN).to_numpy(zero_copy_only=False)
    out = {}
    for i in np.flatnonzero(plain | hidden):
        text = chunk.text_of(i)
        base = plain_spans(text) if plain[i] else []
        more = hidden_spans(text, base) if hidden[i] else []
        if base or more:
            out[int(i)] = (base, more)
    return out


_FIELDS = [
    *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
    T.StructField("base_spans", T.StringType()),
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType()),
]


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts ``n_<kind>`` of plain identifiers, ``base_spans`` and its SHA-256, ``spans`` (all) and ``n_added``."""

    def step(chunk: Chunk, rows: pa.RecordBatch) -> dict:
        n = chunk.n
        counts = np.zeros((len(KINDS), n), np.int64)
        added = np.zeros(n, np.int64)
        base, every = [""] * n, [""] * n
        for i, (plain, more) in find_spans(pc.fill_null(rows.column(1), ""), chunk).items():
            for _, k, _ in plain:
                counts[k, i] += 1
            added[i] = len(more)
            base[i] = render(plain)
            every[i] = render(sorted([*plain, *more]))
        sha = [hashlib.sha256(x.encode()).hexdigest() if x else _EMPTY for x in base]
        return {f"n_{k}": counts[j] for j, k in enumerate(KINDS)} | {"base_spans": base, "base_sha256": sha, "spans": every, "n_added": added}

    return map_text(df, text_col, step, _FIELDS, [id_col])


_EMPTY = hashlib.sha256(b"").hexdigest()


def mask_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span, the leftmost of overlapping ones, replaced by ``[KIND]``."""
    out, at = [], 0
    for s, k, e in sorted(spans, key=lambda x: (x[0], -x[2])):
        if s >= at:
            out += (text[at:s], f"[{KINDS[k].upper()}]")
            at = e
        else:
            at = max(at, e)
    return "".join([*out, text[at:]])


def mask_pii(df: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with identifiers masked in ``text_col`` and ``chars_col`` counted anew; null texts stay null."""
    names = [f"c{k}" for k in range(len(df.columns))]
    at = df.columns.index(text_col)

    def step(chunk: Chunk, rows: pa.RecordBatch) -> dict:
        texts = rows.column(rows.num_columns - 1)
        found = find_spans(pc.fill_null(texts, ""), chunk)
        if not found:
            return {"masked": texts}
        out = texts.to_pylist()
        for i, (plain, more) in found.items():
            out[i] = mask_text(out[i], [*plain, *more])
        return {"masked": pa.array(out, pa.string())}

    # Columns go by place, so any names may stand beside.
    out = map_text(df.toDF(*names), names[at], step, [T.StructField("masked", T.StringType())], [c for c in names if c != names[at]])
    columns = {c: F.col(c) for c in names} | {names[at]: F.col("masked")}
    if chars_col in df.columns:
        chars = names[df.columns.index(chars_col)]
        columns[chars] = F.when(F.col("masked").isNull(), F.col(chars)).otherwise(F.length("masked")).cast(df.schema[chars_col].dataType)
    return out.select(*[columns[c].alias(c) for c in names]).toDF(*df.columns)
