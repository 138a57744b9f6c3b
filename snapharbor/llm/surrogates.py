"""Personal data: detected entities get keyed stand-ins of the same type.

An entity is a kind and a canonical form, so that different spellings of one phone number or
card are the same entity everywhere in the corpus. Its stand-in is drawn with a keyed hash
of kind, form and attempt. Draws are checked in rounds over all entities of the corpus: a draw
that is itself an original, or that another entity already has or wins, is drawn again.
So different entities keep different stand-ins, and every mention of one gets the same.

What a stand-in keeps: separators, letter case, digits, hex and letters as such; check digits of
cards and IBANs; the private range of an IP address; country code and domain ending; for
names after a title, gender and script (Latin, Cyrillic, Greek).
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.shared import batch, prepare, stored

MOST_ATTEMPTS = 200
# Draws that keep the format; later ones widen it, each further than the one before.
KEPT_ATTEMPTS = 8

MENTIONS = pa.schema([("text_key", pa.string()), ("kind", pa.string()), ("form", pa.string())])
DRAWN = pa.schema([("kind", pa.string()), ("form", pa.string()), ("attempt", pa.int32()), ("stand_in", pa.string())])

# Titles with their gender.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m",
    "Don": "m", "Signor": "m", "господин": "m", "г-н": "m", "κύριος": "m", "Κύριος": "m", "Господин": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f",
    "Mademoiselle": "f", "Señora": "f", "Señorita": "f", "Sra": "f", "Srta": "f", "Doña": "f", "Signora": "f",
    "госпожа": "f", "г-жа": "f", "Госпожа": "f", "κυρία": "f", "Κυρία": "f",
    "Dr": "x", "Prof": "x",
}
TITLES |= {title.upper(): gender for title, gender in TITLES.items() if title[0].isupper()}
# What people say before their name.
TITLES |= dict.fromkeys(
    ["My name is", "my name is", "Mein Name ist", "mein Name ist", "Ich heiße", "ich heiße", "Je m'appelle", "je m'appelle",
     "Me llamo", "me llamo", "Mi nombre es", "mi nombre es", "Меня зовут", "меня зовут"], "x",
)
# Two-digit country codes of telephone numbers (fixed values); 1 and 7 have one digit, all others three.
COUNTRIES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98".split()
)
_NAME = r"[A-ZÀ-ÖØ-ÞΑ-ΫΆΈΉΊΌΎΏА-ЯЁ][\w'’-]*"
PATTERN = re.compile(
    r"(?P<email>[\w%+][\w.%+-]*@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,})"
    r"|(?P<assigned>(?i:pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?)(?P<secret>(?=[^\s\"',;]*[^\W_])[^\s\"',;]{6,})"
    r"|(?<![A-Za-z0-9])(?P<cloud>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsu]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,})(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
    r"|(?<![\w:])(?P<ipv6>(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})(?![\w:])"
    r"|(?<![\w:])(?P<short6>(?=[0-9A-Fa-f:]*::)(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})(?![\w:])"
    r"|(?<![\w:])(?P<mac>(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2})(?![\w:])"
    r"|(?<![\w.])(?P<ipv4>(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3})(?!\.?\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<![\w.,])(?P<card>\d{4}(?:[ -]?\d{4}){2}(?:[ -]?\d{1,7})|\d{13,19})(?!\w)"
    r"|(?<![\w.+])(?P<abroad>\+\d{1,4}(?:[ .-]?\(?\d{1,5}\)?){1,5})(?!\w)"
    r"|(?<![\w.-])(?P<phone>\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]\d{3,4}|0\d(?:[ .-]\d{2}){4}|0\d{2,4}[ /-]\d{5,8}|[2-9]\d{9})(?!\w)"
    r"|(?<![A-Za-z0-9])(?P<hex>[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])"
    rf"|\b(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.?\s+(?P<name>{_NAME}(?:\s{_NAME}){{0,2}})"
)
def _by_initial(words: list[str]) -> str:
    """Alternatives of which a regular expression tries only those with the right first letter."""
    initials = sorted({w[0] for w in words})
    return "|".join(f"{c}(?:{'|'.join(sorted(w[1:] for w in words if w[0] == c))})" for c in initials)


# A text without any of these has no match; Spark tests it before the text goes to Python.
HINT = (
    r"[\p{Nd}@=:]|(?<![A-Za-z0-9])(?:sk-|gh[opsu]_|AKIA|ASIA|[a-f]{32}|[A-F]{32}|" + _by_initial(list(TITLES)) + ")"
)
_CLOUD = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsu]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}")

_DIGITS, _HEX, _LETTERS = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
_VOWELS = {"l": "aeiou", "c": "аеиоу", "g": "αεηιο"}
_CONSONANTS = {"l": "bdfgklmnprstv", "c": "бвдгклмнпрст", "g": "βγδκλμνπρστ"}
# Endings by kind of name, gender and script.
_ENDINGS = {
    ("given", "m"): {"l": "n", "c": "н", "g": "ος"},
    ("given", "f"): {"l": "a", "c": "а", "g": "α"},
    ("given", "x"): {"l": "e", "c": "е", "g": "ι"},
    ("family", "m"): {"l": "er", "c": "ов", "g": "ίδης"},
    ("family", "f"): {"l": "er", "c": "ова", "g": "ίδου"},
    ("family", "x"): {"l": "er", "c": "ко", "g": "άκη"},
}


def script_of(word: str) -> str:
    first = word[:1].lower()
    return "c" if "а" <= first <= "ё" else "g" if "Ͱ" <= first <= "Ͽ" else "l"


class Draw:
    """An endless stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()
        self.pool, self.turn = 0, 0
        self.room = 1

    def below(self, n: int) -> int:
        if self.room < n << 32:
            block = hashlib.sha256(self.seed + self.turn.to_bytes(4, "big")).digest()
            self.turn += 1
            self.pool, self.room = int.from_bytes(block, "big"), 1 << 256
        self.pool, value = divmod(self.pool, n)
        self.room //= n
        return value

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]


def like(form: str, draw: Draw) -> str:
    """Each digit by a digit and each letter by one of its case; a hex string stays one."""
    letters = [c for c in form if c.isalpha()]
    alike = "abcdef" if letters and all(c in "abcdefABCDEF" for c in letters) and any(c.isdigit() for c in form) else "abcdefghijklmnopqrstuvwxyz"
    out = []
    for c in form:
        if c.isdigit():
            out.append(draw.of("0123456789"))
        elif c.isalpha():
            out.append(draw.of(alike.upper() if c.isupper() else alike))
        else:
            out.append(c)
    return "".join(out)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def stand_in(key: bytes, kind: str, form: str, attempt: int) -> str:
    """The canonical form of the ``attempt``-th stand-in.

    From ``KEPT_ATTEMPTS`` on it is longer by a character or digit per attempt, an IPv4 address leaves
    its private range, and IPv6 and hardware addresses use all hex digits: no format is ever full.
    """
    draw = Draw(key, kind, form, attempt)
    wider = max(0, attempt - KEPT_ATTEMPTS + 1)

    def more(letters: str) -> str:
        return "".join(draw.of(letters) for _ in range(wider))

    if kind == "email":
        local, _, domain = form.partition("@")
        labels = domain.split(".")
        # one domain has one stand-in, whoever writes from it
        inside = like(".".join(labels[:-1]), Draw(key, "domain", domain))
        return f"{like(local, draw)}{more(_LETTERS)}@{inside}.{labels[-1]}"
    if kind == "card":
        digits = draw.of("123456789") + like(form[1:], draw)
        return next(d for c in "0123456789" if luhn(d := digits[:-1] + c)) if luhn(form) else digits
    if kind == "iban":
        rest = like(form[4:], draw) + more(_DIGITS)
        return form[:2] + _iban_check(form[:2], rest) + rest
    if kind == "ipv4":
        if wider > 2 * KEPT_ATTEMPTS:  # a unique local IPv6 address
            return "fd" + ":".join("".join(draw.of(_HEX) for _ in range(n)) for n in (2, *[4] * 7))
        octets = [int(x) for x in form.split(".")]
        private = octets[0] in (10, 127) or octets[:2] == [192, 168] or octets[0] == 172 and 16 <= octets[1] < 32
        fixed = 0 if not private else 1 if octets[0] in (10, 127) else 2
        if wider:
            octets, fixed = [10] * 4, int(wider <= KEPT_ATTEMPTS)
        public = [n for n in range(11, 224) if n not in (127, 172, 192)]
        drawn = [public[draw.below(len(public))], *(draw.below(256) for _ in range(2)), 1 + draw.below(254)]
        return ".".join(map(str, octets[:fixed] + drawn[fixed:]))
    if kind == "ssn":
        return f"{100 + draw.below(500)}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}{more(_DIGITS)}"
    if kind.startswith("phone"):
        return draw.of("23456789") + like(form[1:], draw) + more(_DIGITS)
    if kind == "cloud":
        head = re.match(r"AKIA|ASIA|gh._|sk-", form).group()
        return head + like(form[len(head) :], draw) + more(_LETTERS.upper() if head in ("AKIA", "ASIA") else _LETTERS)
    if kind.startswith(("given", "family")):
        part, gender, script = kind.split("_")
        pairs = 1 + draw.below(2) + attempt // 8  # longer names when short ones run out
        body = "".join(draw.of(_CONSONANTS[script]) + draw.of(_VOWELS[script]) for _ in range(pairs))
        return body + draw.of(_CONSONANTS[script]) + _ENDINGS[part, gender][script]
    if kind in ("ipv6", "mac"):
        if wider:
            size, many = (4, 8) if kind == "ipv6" else (2, 6)
            return ("-" if "-" in form else ":").join("".join(draw.of(_HEX) for _ in range(size)) for _ in range(many))
        return like(form, draw)
    # secrets and hashes: a hex string stays one
    return like(form, draw) + more(_HEX if re.fullmatch("[0-9a-f]+", form) else _HEX.upper() if re.fullmatch("[0-9A-F]+", form) else _LETTERS)


def canonical(kind: str, text: str) -> str:
    if kind in ("card", "ssn") or kind.startswith("phone"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind in ("email", "ipv6", "mac"):
        return text.lower()
    if kind.startswith(("given", "family")):
        return text.lower()
    return text


def rendered(kind: str, text: str, form: str) -> str:
    """A stand-in written the way ``text`` is."""
    if kind in ("card", "ssn", "iban") or kind.startswith("phone"):
        left = iter(form)
        return "".join(next(left) if c.isalnum() else c for c in text) + "".join(left)
    if kind in ("email", "ipv6", "mac"):
        if text.isupper():
            return form.upper()
        same = len(text) == len(form)
        return "".join(c.upper() if same and t.isupper() else c for c, t in zip(form, text)) if same else form
    if kind.startswith(("given", "family")):
        if len(text) > 1 and text.isupper():
            return form.upper()
        return form[:1].upper() + form[1:]
    return form


def country_of(digits: str) -> str:
    """The country code that a number written with a plus begins with."""
    return digits[:1] if digits[:1] in "17" else digits[:2] if digits[:2] in COUNTRIES else digits[:3]


def family_gender(word: str) -> str:
    """The gender that the form of a family name shows, whatever title stands before it."""
    script, end = script_of(word), word.lower()
    if script == "c":
        return "f" if end.endswith(("а", "я")) else "x" if end.endswith(("о", "и", "ы", "х")) else "m"
    if script == "g":
        return "m" if end.endswith(("ς", "σ")) else "f" if end.endswith(("ου", "α", "ά", "η", "ή")) else "x"
    return "x"


def _name_kinds(titled: list[tuple[str, str, str]]) -> dict[str, str]:
    """Kind of each word of a text's titled names, given as (word, role, gender).

    A word is one name throughout a text: after a title alone it is what it is beside other names, a family name
    if nothing else is known. A given name has the gender that its titles agree on. The kind of a family
    name does not depend on titles, so that Mr, Mrs and Dr Smith share one.
    """
    roles: dict[str, set[str]] = {}
    genders: dict[str, set[str]] = {}
    for word, role, gender in titled:
        roles.setdefault(word.lower(), set()).add(role)
        genders.setdefault(word.lower(), set()).add(gender)
    kinds = {}
    for word, found in roles.items():
        if "family" in found or "given" not in found:
            kinds[word] = f"family_{family_gender(word)}_{script_of(word)}"
        else:
            known = genders[word] - {"x"}
            kinds[word] = f"given_{known.pop() if len(known) == 1 else 'x'}_{script_of(word)}"
    return kinds


def _plain_word(text: str) -> bool:
    """What follows "password:" in a sentence is a word, not a password."""
    return re.fullmatch(r"[^\W\d_]?[^\W\d_A-Z]+[.!?)]*", text) is not None


def mentions(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, in order, without overlap."""
    found: list[tuple[int, int, str]] = []
    titled: list[tuple[int, int, str, str, str]] = []
    for m in PATTERN.finditer(text):
        kind = m.lastgroup
        if kind == "name":
            words = list(re.finditer(_NAME, m["name"]))
            words = [w for w in words if script_of(w.group()) == script_of(words[0].group())]
            for k, w in enumerate(words):
                role = "single" if len(words) == 1 else "family" if k == len(words) - 1 else "given"
                at = m.start("name")
                titled.append((at + w.start(), at + w.end(), w.group(), role, TITLES[m["title"]]))
        elif kind == "abroad":
            digits = re.sub(r"\D", "", m[kind])
            if not 8 <= len(digits) <= 15:
                continue
            code = country_of(digits)
            start = re.match(r"\+" + r"\D*".join(code) + r"[ .-]*", m[kind]).end()
            # numbers are written with or without +1
            found.append((m.start() + start, m.end(), "phone" if code == "1" else f"phone_{code}"))
        elif kind == "phone":
            if 7 <= len(re.sub(r"\D", "", m[kind])) <= 12 and not re.fullmatch(r"\d{1,3}(?:\.\d{3})+", m[kind]):
                found.append((*m.span(kind), kind))
        elif kind == "short6":
            try:
                digits = m[kind].replace(":", "")
                if len(digits) > 3 and any(c.isdigit() for c in digits):
                    ipaddress.IPv6Address(m[kind])
                    found.append((*m.span(kind), "ipv6"))
            except ValueError:
                continue
        elif kind == "secret" and _plain_word(m[kind]):
            continue
        else:
            span = m.span(kind)
            if kind in ("secret", "hex", "cloud"):  # one value is one entity, however it is introduced
                kind = "cloud" if _CLOUD.fullmatch(m[kind]) else "secret"
            found.append((*span, kind))
    if titled:
        kinds = _name_kinds([t[2:] for t in titled])
        found += [(a, b, kinds[word.lower()]) for a, b, word, _, _ in titled]
        taken = sorted((a, b) for a, b, _ in found)
        spellings = {s for _, _, w, _, _ in titled for s in (w, w.upper(), w.capitalize() if w.isupper() else w)}
        # later mentions without a title
        for m in re.finditer(r"\b(?:" + "|".join(map(re.escape, sorted(spellings, key=len, reverse=True))) + r")\b", text):
            at = bisect.bisect_left(taken, (m.end(),))
            if not (at and taken[at - 1][1] > m.start()):
                found.append((*m.span(), kinds[m.group().lower()]))
        found.sort()
    return found


def _detect(batches: Iterator[pa.RecordBatch]):
    seen: set[str] = set()
    for rows in batches:
        out = []
        for key, text in zip(rows.column("text_key").to_pylist(), rows.column("text").to_pylist()):
            if key not in seen:
                seen.add(key)
                out += [(key, kind, form) for kind, form in {(k, canonical(k, text[a:b])) for a, b, k in mentions(text)}]
        if out:
            yield batch(MENTIONS, *map(list, zip(*out)))


def _drawn(key: bytes):
    def run(batches):
        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("kind", "form", "attempt")]
            yield batch(DRAWN, *columns, [stand_in(key, *entity) for entity in zip(*columns)])

    return run


def _rewrite(text_col: str, list_col: str, key_col: str):
    def run(batches):
        for rows in batches:
            place = rows.schema.get_field_index(text_col)
            texts = []
            for text, entities in zip(rows.column(text_col).to_pylist(), rows.column(list_col).to_pylist()):
                if entities:
                    new = {(e["kind"], e["form"]): e["stand_in"] for e in entities}
                    parts, last = [], 0
                    for a, b, kind in mentions(text):
                        old = text[a:b]
                        parts += [text[last:a], rendered(kind, old, new[kind, canonical(kind, old)])]
                        last = b
                    text = "".join([*parts, text[last:]])
                texts.append(text)
            rows = rows.set_column(place, rows.schema.field(place), pa.array(texts, rows.schema.field(place).type))
            yield rows.drop_columns([list_col, key_col])

    return run


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, form, stand_in) for distinct (kind, form): no two share a stand-in within a kind of
    characters, and none is an original.

    Each round draws for the entities that have none yet. Of equal draws the entity with the smallest
    hash wins; the others, and those that drew an original or a stand-in already given, go on. Formats
    widen with the attempts, so that the bound on them is never met by ``stand_in``.
    """
    secret = key.encode()
    entities = stored(entities.withColumn("attempt", F.lit(0)), "entities")
    # names of either gender may not meet: compare by the last word of the kind only
    group = F.regexp_replace("kind", "_.*", "")
    originals = entities.select(group.alias("kind_group"), F.col("form").alias("stand_in"))
    done, pending = None, entities
    ddl = "kind string, form string, attempt int, stand_in string"
    for _ in range(MOST_ATTEMPTS):
        drawn = stored(pending.mapInArrow(_drawn(secret), ddl).withColumn("kind_group", group), "drawn")
        taken = originals if done is None else originals.unionByName(done.select("kind_group", "stand_in"))
        free = drawn.join(taken, ["kind_group", "stand_in"], "left_anti")
        first = free.groupBy("kind_group", "stand_in").agg(
            F.min(F.struct(F.xxhash64("kind", "form").alias("h"), "kind", "form", "attempt")).alias("e")
        )
        won = stored(first.select("kind_group", "stand_in", "e.kind", "e.form", "e.attempt"), "won")
        done = won if done is None else done.unionByName(won)
        again = drawn.join(won.select("kind", "form"), ["kind", "form"], "left_anti")
        pending = stored(again.select("kind", "form", (F.col("attempt") + 1).cast("int").alias("attempt")), "pending")
        if pending.isEmpty():
            return done.select("kind", "form", "stand_in")
    raise ValueError(f"no free stand-in after {MOST_ATTEMPTS} draws: a format has too few values")


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every detected entity of ``text_col`` replaced; rows and other columns stay.

    The same key gives the same stand-ins for the same corpus. Null, empty and entity-free texts
    are unchanged. Equal texts are changed alike, whatever their ids; repeated rows stay. Columns may have
    any names. Overlapping candidates: the leftmost wins, then the order of the kinds.
    """
    prepare(docs.sparkSession)
    names = {c.lower() for c in docs.columns}
    key_col, list_col = "_text_key", "_entities"
    while key_col in names or list_col in names:
        key_col, list_col = f"_{key_col}", f"_{list_col}"
    hit = F.coalesce(F.col(text_col).rlike(HINT), F.lit(False))
    text_key = F.sha2(F.col(text_col), 256)
    candidates = docs.where(hit)
    found = candidates.select(text_key.alias("text_key"), F.col(text_col).alias("text"))
    found = stored(found.mapInArrow(_detect, "text_key string, kind string, form string").distinct(), "mentions")
    stand_ins = stored(assign(found.select("kind", "form").distinct(), key), "stand-ins")
    known = found.join(stand_ins, ["kind", "form"])
    known = known.groupBy("text_key").agg(F.collect_list(F.struct("kind", "form", "stand_in")).alias(list_col))
    known = stored(known.withColumnRenamed("text_key", key_col), "of-text")
    joined = candidates.withColumn(key_col, text_key).join(known, key_col, "left")
    joined = joined.select(*(F.col(f"`{c}`") for c in docs.columns), list_col, key_col)
    changed = joined.mapInArrow(_rewrite(text_col, list_col, key_col), docs.schema)
    return changed.unionByName(docs.where(~hit))
