"""Surrogates for personal data and secrets.

``detect`` finds e-mail addresses, phone, card, account and social security numbers, IP addresses
(also version 6), access keys, secrets and names after a title in Latin, Cyrillic or Greek script; where
a text has a titled name, also its full, given-name and family-name mentions without a title, as one
entity (two persons of a text with one given or family name: the first has the bare mentions).  Each entity (its type and canonical value, so that
"+1 (456) 555-2186" and "+1 456 555 2186" are one) gets a replacement drawn from an HMAC of a secret
key: digits stay digits, letters letters of their case, country codes, key prefixes and top-level domains stay,
card and account numbers keep valid check digits, names keep gender and script, and each mention keeps its own
punctuation.  The same entity has the same surrogate in every document (coreference).

Distinctness is checked over the whole corpus: a surrogate that two entities of a type drew, or that
is itself an entity of the corpus, is kept by the smallest entity (or none) and the others draw
again, round after round, until all differ: from the fifth round on every round draws from longer forms, so
that the rounds end however full a short shape is.

Card and account numbers are entities only with valid check digits.

At scale: texts without a trace of an entity pass through one narrow scan; the others, a small
share, are written once; what is shuffled is distinct entities and those texts' keys.  Rounds are
joins and aggregates over distinct entities; nothing is collected or broadcast.

Defined cases: null and empty texts and null ids stay as they are; n_chars, where it is a column and not
null, follows the new text; repeated rows are each rewritten alike; other columns, of whatever name, are kept; an
empty table gives no rows; a text is worked on whole, at a few bytes of memory for each of its own.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm.common import materialise, plain_names, ship, slices

#: Given names by gender and family names, by script.
NAMES = {
    "latin": {"f": ["Anna", "Clara", "Emma", "Helen", "Julia", "Laura", "Maria", "Nora", "Paula", "Sofia"], "m": ["Adam", "Daniel", "David", "Felix", "Henry", "Lucas", "Martin", "Paul", "Simon", "Victor"], "family": ["Adler", "Baker", "Costa", "Duval", "Fischer", "Garcia", "Keller", "Laurent", "Miller", "Navarro", "Porter", "Romero", "Schmidt", "Turner", "Weber"]},
    "cyrillic": {"f": ["Анна", "Вера", "Елена", "Мария", "Ольга"], "m": ["Антон", "Борис", "Иван", "Павел", "Юрий"], "family": ["Белов", "Громов", "Козлов", "Морозов", "Павлов", "Соколов"]},
    "greek": {"f": ["Άννα", "Ελένη", "Μαρία", "Σοφία"], "m": ["Αλέξης", "Νίκος", "Πέτρος", "Στέφανος"], "family": ["Δούκας", "Λάσκαρης", "Νικολάου", "Παππάς"]},
}
#: Titles that stand before a name, by the gender they tell ("" where they tell none).
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Doña", "Lady", "Dame", "Госпожа", "госпожа", "Г-жа", "г-жа", "Κυρία", "κυρία", "Κα", "κα"], "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "Lord", "Господин", "господин", "Г-н", "г-н", "Κύριος", "κύριος", "Κύριο", "κύριο"], "": ["Dr", "Prof", "Professor", "Доктор", "доктор", "Профессор", "профессор", "Δρ", "Καθηγητής"]}

#: Attempts that keep the shape of a value.
KEEP_SHAPE = 4

_TITLE = {t: g for g, ts in TITLES.items() for t in ts}
_UP = "[" + "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isupper() and c.isalpha()) + "]"
_WORD = rf"{_UP}[^\W\d_]+(?:[-'’]{_UP}[^\W\d_]+)*"
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"),
    ("access_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("secret", r"(?i:(?<![a-z0-9])(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?)(?P<secret>[A-Za-z0-9+/_\-]{8,})"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ipv6", r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:(?:[0-9]{1,3}\.){3}[0-9]{1,3}|[0-9A-Fa-f]{0,4})(?![0-9A-Za-z:])"),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])"),
    ("phone", r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z.\-])[0-9]{3}[.\- ][0-9]{3}[.\- ][0-9]{4}(?![0-9])"),
    ("ssn", r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"),
    ("card", r"(?<![0-9A-Za-z])[0-9]{4}(?:[ \-][0-9]{4}){3}(?![0-9])|(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])"),
    ("name", r"(?<!\w)(?P<title>" + "|".join(sorted(_TITLE, key=len, reverse=True)) + rf")\.? (?P<name>(?:{_UP}\. )*{_WORD}(?:(?: {_UP}\.)* {_WORD})?)"),
]
_ALL = re.compile("|".join(f"(?P<{k}_>{p})" for k, p in PATTERNS))
#: No entity without one of these: a cheap test that most texts fail.
_TRACE = re.compile(r"[0-9@]|(?i:password|passwd|pwd|token|secret|api.?key)\s{0,2}[=:]|(?<!\w)(?:" + "|".join(_TITLE) + r")\.? ")


def script_of(word: str) -> str:
    c = next((ord(x) for x in word if x.isalpha()), 65)
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def canonical(kind: str, value: str, title: str | None = None) -> str:
    """What mentions of one entity have in common."""
    if kind == "email":
        return value.lower()
    if kind in ("phone", "card", "ssn"):
        return "".join(c for c in value if c.isdigit() or c == "+")
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ipv6":
        return ipaddress.IPv6Address(value).exploded
    if kind == "name":
        given = value.split()[0]
        gender = _TITLE.get(title or "") or next((g for s in NAMES.values() for g in "fm" if given in s[g]), "f")
        return f"{gender}:{value}"
    return value


def _words(name: str) -> list[str]:
    """The words of a name that are not initials."""
    return [w for w in name.split() if not w.endswith(".")]


def _persons(names: list[tuple[str, str]]) -> dict[tuple[str, str], str]:
    """The canonical value of each (title, name) of a text: titles and short forms of one person have the same."""
    full, of = {}, {}
    for title, name in sorted(set(names), key=lambda n: (not _TITLE[n[0]], names.index(n))):
        if len(_words(name)) == 2:
            # the title that tells a gender goes first; without one, the name is that of a gendered mention
            same = next((v for v in full if v[2:] == name), None) if not _TITLE[title] else None
            of[title, name] = same or canonical("name", name, title)
            full[of[title, name]] = _words(name)
    for title, name in names:
        if len(_words(name)) == 1:
            word, initial, gender = _words(name)[0], name[0] if name[1:2] == "." else "", _TITLE[title]
            fits = [v for v, w in full.items() if word in (w if not initial else w[1:]) and gender in ("", v[0]) and w[0].startswith(initial)]
            of[title, name] = min(fits, key=lambda v: full[v][1] != word) if fits else canonical("name", name, title)
    return of


def _mentions(values: list[str]) -> tuple[re.Pattern, dict[str, str]]:
    """A pattern of the full, given and family names of persons, and the person of each."""
    by = {}
    for value in values:
        by.setdefault(value[2:], value)
    for value in values:
        words = _words(value[2:])
        for form in (" ".join(words), words[-1], words[0]):
            by.setdefault(form, value)
    forms = "|".join(re.escape(x) for x in sorted(by, key=len, reverse=True))
    return re.compile(rf"(?<!\w)(?P<form>{forms})(?!\w)"), by


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(first, end, type, canonical value) of the entities in a text, in order, without overlaps."""
    if not text or not _TRACE.search(text):
        return []
    out, titles = [], {}
    for m in _ALL.finditer(text):
        kind = m.lastgroup if m.lastgroup.endswith("_") else next(k for k, v in m.groupdict().items() if v is not None and k.endswith("_"))
        kind = kind[:-1]
        group = {"secret": "secret", "name": "name"}.get(kind, 0)
        if kind == "name":
            titles[m.start(group)] = m.group("title"), m.group("name")
            out.append((m.start(group), m.end(group), kind, ""))
            continue
        if kind == "ipv6" and not any(c.isdigit() for c in m.group()):  # a::b is code
            continue
        try:
            value = canonical(kind, m.group(group))
        except ipaddress.AddressValueError:  # a time or the like
            continue
        if kind == "card" and luhn(value[:-1]) != value[-1] or kind == "iban" and _rest(value[4:] + value[:4]) != 1:
            continue  # an order or part number
        out.append((m.start(group), m.end(group), kind, value))
    if not titles:
        return out
    of = _persons(list(titles.values()))
    out = [(a, b, k, of[titles[a]] if k == "name" else v) for a, b, k, v in out]
    pattern, by = _mentions([v for _, _, k, v in out if k == "name"])
    at = 0
    for a, b, _, _ in [*out, (len(text), len(text), "", "")]:
        out += [(*m.span("form"), "name", by[m.group("form")]) for m in pattern.finditer(text, at, a)]
        at = b
    return sorted(out)


class _Stream:
    """Numbers below a bound, from the HMAC of an entity and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.label, self.n, self.rest = key, f"{kind}|{attempt}|{value}".encode(), 0, b""

    def below(self, bound: int) -> int:
        if len(self.rest) < 4:
            self.rest = hmac.new(self.key, self.label + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        x, self.rest = int.from_bytes(self.rest[:4], "big"), self.rest[4:]
        return x % bound

    def alike(self, text: str, hexadecimal: bool = False) -> str:
        """Digits for digits and letters for letters of the same case."""
        letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
        return "".join(str(self.below(10)) if c.isdigit() else letters[self.below(len(letters))].upper() if c.isupper() else letters[self.below(len(letters))] if c.isalpha() else c for c in text)


def luhn(body: str) -> str:
    """The check digit of a card number without it."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _rest(text: str) -> int:
    """What is left of an account number, letters as two digits, over 97."""
    return int("".join(str(int(c, 36)) for c in text)) % 97


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical form of an entity's replacement at the given attempt.

    The first ``KEEP_SHAPE`` attempts keep the shape of the value.  From then on every attempt adds a letter, digit
    or initial (addresses first take octets of any length, then become version 6), so that the forms to draw
    from outnumber any corpus after a few rounds.
    """
    s = _Stream(key, kind, value, attempt)
    more = max(0, attempt - KEEP_SHAPE + 1)
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{s.alike(local + 'x' * more)}@{s.alike(host)}.{top}"
    if kind == "phone":
        digits = value + "0" * more
        if value.startswith("+"):
            code = 1 if value[1] in "17" else 2
            return value[: 1 + code] + str(2 + s.below(8)) + s.alike(digits[2 + code :])
        return str(2 + s.below(8)) + s.alike(digits[1:])
    if kind == "card":
        body = value[0] + s.alike(value[1:-1] + "0" * more)
        return body + luhn(body)
    if kind == "iban":
        body = s.alike(value[4:] + "0" * more)
        return f"{value[:2]}{98 - _rest(body + value[:2] + '00'):02d}{body}"
    if kind == "ip":
        if more > KEEP_SHAPE:
            return ipaddress.IPv6Address("fd00" + "".join(":" + s.alike("0a0a", hexadecimal=True) for _ in range(7))).exploded
        low = {1: (1, 9), 2: (10, 90), 3: (100, 156)} if not more else dict.fromkeys((1, 2, 3), (1, 255))
        return ".".join(str(low[len(p)][0] + s.below(low[len(p)][1])) for p in value.split("."))
    if kind == "ipv6":
        return value[:4] + s.alike(value[4:], hexadecimal=True)
    if kind == "access_key":
        return value[:4] + (s.alike(value[4:]) if not more else "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[s.below(36)] for _ in value[4:]))
    if kind == "secret":
        return s.alike(value + "a0"[len(value) % 2] * more, hexadecimal=re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) is not None)
    if kind == "name":
        gender, _, name = value.partition(":")
        names = NAMES[script_of(name)]
        # no part of a name is kept
        givens, families = ([n for n in names[k] if n not in name.split()] for k in (gender, "family"))
        given, family = givens[s.below(len(givens))], families[s.below(len(families))]
        initials = [names["family"][s.below(len(names["family"]))][0] + "." for _ in range(more)]
        out = " ".join([given, *initials, family]) if " " in name else " ".join([*initials, family])
        return f"{gender}:{out}"
    return s.alike(value + "0" * more)


def render(kind: str, mention: str, replacement: str, value: str = "", others: frozenset[str] = frozenset()) -> str:
    """The replacement in the punctuation and case of a mention; short for a short name, unless one of ``others`` shares the word."""
    if kind == "name":
        whole, old, new = replacement[2:], _words(value[2:]), _words(replacement[2:])
        short = _words(mention)
        if len(old) == len(new) == 2 and len(short) == 1:
            part = new[0] if short[0] == old[0] != old[1] else new[1]
            return part if not any(part in _words(o[2:]) for o in others if o != replacement) else whole
        return whole
    if kind == "ipv6" or kind == "ip" and ":" in replacement:
        return ipaddress.IPv6Address(replacement).compressed
    if kind in ("phone", "card", "ssn", "iban"):
        chars = iter(replacement)
        return "".join(next(chars) if c.isalnum() or c == "+" else c for c in mention) + "".join(chars)
    if kind == "email" and len(replacement) == len(mention):
        return "".join(r.upper() if c.isupper() else r for c, r in zip(mention, replacement))
    return replacement


def rewrite(text: str, by: dict[tuple[str, str], str]) -> str:
    out, at = [], 0
    names = frozenset(new for (kind, _), new in by.items() if kind == "name")
    for first, end, kind, value in detect(text):
        out += [text[at:first], render(kind, text[first:end], by[kind, value], value, names)]
        at = end
    return "".join([*out, text[at:]])


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) of distinct (kind, value), all surrogates of a kind distinct and none an entity."""
    ship(entities.sparkSession)
    done, pending, attempt = None, entities, 0
    while True:
        def draw(batches: Iterator[pa.RecordBatch], attempt=attempt) -> Iterator[pa.RecordBatch]:
            for b in batches:
                kinds, values = b.column(0).to_pylist(), b.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([surrogate(key, k, v, attempt) for k, v in zip(kinds, values)], pa.string())], ["kind", "value", "surrogate"])

        drawn = pending.select("kind", "value").mapInArrow(draw, "kind string, value string, surrogate string")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        won = first.join(entities.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            won = won.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won, _ = materialise(won.select("kind", "value", "surrogate"), "won")
        done = won if done is None else done.unionByName(won)
        pending, _ = materialise(pending.join(won, ["kind", "value"], "left_anti").select("kind", "value"), "pending")
        attempt += 1
        if pending.isEmpty():
            return done


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """The rows of ``docs`` with every entity replaced, and n_entities (a column of that name is replaced)."""
    spark = docs.sparkSession
    ship(spark)
    rows, own = plain_names(docs, "n_entities")
    where = own.index("text")
    rows = rows.withColumn(f"c{where}", F.col(f"c{where}").cast("string"))
    names = rows.columns
    typed = lambda more: T.StructType([*rows.schema.fields, *T.StructType.fromDDL(more).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for b in batches:
            for at, texts in slices(b.column(where)):
                found = [sorted({(k, v) for _, _, k, v in detect(t)}) for t in texts]
                part, n = b.slice(at, len(texts)), len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(range(number, number + n), pa.int64()), pa.array([[{"kind": k, "value": v} for k, v in f] for f in found], pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())])))], [*names, "row", "found"])
                number += n

    scanned, _ = materialise(rows.mapInArrow(scan, typed("row long, found array<struct<kind:string,value:string>>")), "scanned")
    mentions = scanned.where("size(found) > 0").select("row", F.explode("found").alias("e")).select("row", "e.kind", "e.value")
    entities, _ = materialise(mentions.select("kind", "value").distinct(), "entities")
    given = mentions.join(assign(entities, key), ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("given"))
    dirty = scanned.where("size(found) > 0").join(given, "row").select(*names, "given")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(where).to_pylist()
            by_row = [{(g["kind"], g["value"]): g["surrogate"] for g in gs} for gs in b.column(len(names)).to_pylist()]
            columns = [pa.array([rewrite(t, g) for t, g in zip(texts, by_row)], pa.string()) if i == where else c for i, c in enumerate(b.columns[: len(names)])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([len(g) for g in by_row], pa.int64())], [*names, "n"])

    changed = dirty.mapInArrow(apply, typed("n long"))
    if "n_chars" in own:
        c = f"c{own.index('n_chars')}"
        changed = changed.withColumn(c, F.when(F.col(c).isNotNull(), F.length(f"c{where}").cast(rows.schema[c].dataType)))
    same = scanned.where("size(found) = 0").select(*names, F.lit(0).cast("long").alias("n"))
    return same.unionByName(changed).toDF(*own, "n_entities")
