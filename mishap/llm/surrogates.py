"""Operator 4: personal data replaced by keyed, type-consistent surrogates."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.llm.common import Batches, chunks, free_name, map_batches, store, table

QUERY_KEY = b"surrogate key of the registered query"
CHUNK_BYTES = 4 * 1024 * 1024
MAX_BROADCAST = 100_000
"""Redrawn entities (collisions only) that are sent to every task; more are joined to the texts that hold them."""

# Honorifics and the gender they tell, common given names, syllables of drawn surnames.
HONORIFICS = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m",
              "Mrs": "f", "Ms": "f", "Miss": "f", "Mme": "f", "Madame": "f", "Mlle": "f", "Frau": "f", "Señora": "f",
              "Sra": "f", "Dr": "n", "Prof": "n", "г-н": "m", "г-жа": "f", "κ": "m", "κα": "f"}
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Thomas Daniel Paul Peter Hans Karl Pierre Louis Carlos Juan",
    ("latin", "f"): "Mary Anna Linda Susan Karen Emma Laura Julia Maria Helen Greta Petra Claire Louise Carmen Lucia",
    ("latin", "n"): "Alex Robin Kim Sam Jordan Taylor Morgan Casey Jamie Riley Andrea Dominique Camille Noel Sasha Nikita",
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Михаил Николай Андрей",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана",
    ("cyrillic", "n"): "Саша Женя Валя",
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης",
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Άννα",
    ("greek", "n"): "Αλέξης Άρις Ευδοκία",
}
SYLLABLES = {
    "latin": "bar bel car dan der dor fal fen gar hal har kel lan lor mar mel nor pel ral ren sal ser tam tor val ven",
    "cyrillic": "бар бел вол гор дан зар кол лев мар мир нев пет рад сер тар хол",
    "greek": "βασ γιαν δημ καρ λαμ μαν νικ παπ σταθ τσακ φιλ χατ",
}
ENDINGS = {"latin": "son man ton ley by er", "cyrillic": "ов ин ский", "greek": "ίδης όπουλος άκης"}
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLE = "|".join(sorted(map(re.escape, HONORIFICS), key=len, reverse=True))
_NAME = r"[^\W\d_a-zа-яα-ω][^\W\d_]+(?:[-'’][^\W\d_]+)?"
_FORM = re.compile("|".join([
    r"(?P<email>(?<![\w.%+-])[\w.%+-]*\w@\w[\w-]*(?:\.\w[\w-]*)+)",
    r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?)(?P<secret>[^\s\"']{6,})",
    r"(?P<access>\b(?:AKIA|ASIA|ghp_|gho_|sk-|xox[abp]-)[0-9A-Za-z_-]{16,}\b)",
    rf"(?P<ip>(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d))",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)",
    r"(?P<card>(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d.-]*\d))",
    r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
    r"(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}"
    r"|\d{3}[.-]\d{3}[.-]\d{4})(?!\d))",
    rf"\b(?P<title>{_TITLE})\.? (?P<name>{_NAME}(?: {_NAME})?)",
]))
# What every entity has: a digit, @, = or :, an honorific before a space, or an access key's first letters.
_MARK = re.compile(r"[@\d=:]")
# First letters of access keys, which their surrogates keep.
_LEAD = re.compile(r"AKIA|ASIA|gh[po]_|sk-|xox[abp]-|")
ROOM = 8
"""Draws in a secret's own form; later ones are longer by one more letter each, so few free places can't run out."""
_CALLS = (*(t + end for t in HONORIFICS for end in (" ", ". ")), "AKIA", "ASIA", "ghp_", "gho_", "sk-", "xox")


SYMBOLS = "!#$%&*+,-./:;<=>?@^_|~"


def _plain(text: str) -> bool:
    """Whether no character is a letter or digit, which ``Draw.like`` changes."""
    return not any(c.isalpha() or c.isdigit() for c in text)


def _blank(secret: str) -> bool:
    """A form's line or a mask instead of a secret: at most two different symbols and no letter or digit."""
    rest = secret[_LEAD.match(secret).end():]
    return _plain(rest) and len(set(rest)) <= 2


@dataclass(frozen=True)
class Entity:
    """One mention: where it stands, its kind (with gender and script for names) and its normal form."""
    start: int
    end: int
    kind: str
    value: str


def _luhn(digits: str) -> int:
    """The check digit that makes ``digits`` followed by it valid."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


_WORD = re.compile(r"\w+")


def _script(word: str) -> str:
    first = word[0].lower()
    return "cyrillic" if "а" <= first <= "ё" or "Ѐ" <= word[0] <= "ӿ" else "greek" if "Ͱ" <= word[0] <= "Ͽ" else "latin"


def _gender(given: str, told: str) -> str:
    if told != "n":
        return told
    return next((g for (_, g), names in GIVEN.items() if g != "n" and given in names.split()), "n")


def detect(text: str) -> list[Entity]:
    """Entities of a text in order, none overlapping.

    A surname introduced with an honorific is found again wherever it stands
    alone, so all its mentions change alike.
    """
    if not _MARK.search(text) and not any(c in text for c in _CALLS):
        return []
    found: list[Entity] = []
    surnames: dict[str, str] = {}
    for m in _FORM.finditer(text):
        kind = m.lastgroup
        if kind == "name":
            parts, at = m["name"].split(" "), m.start("name")
            if len(parts) == 2:
                g = _gender(parts[0], HONORIFICS[m["title"]])
                found.append(Entity(at, at + len(parts[0]), f"given {_script(parts[0])} {g}", parts[0].casefold()))
                at += len(parts[0]) + 1
            kind = f"surname {_script(parts[-1])}"
            found.append(Entity(at, at + len(parts[-1]), kind, parts[-1].casefold()))
            surnames[parts[-1]] = kind
            continue
        value = m[kind]
        if kind in ("card", "phone", "ssn"):
            value = re.sub(r"\D", "", value)
            if kind == "card" and _luhn(value[:-1]) != int(value[-1]):
                continue
        elif kind == "iban":
            value = value.replace(" ", "")
            if int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 != 1:
                continue
        elif kind == "email":
            value = value.lower()
        elif kind in ("secret", "access") and _blank(value):
            continue
        found.append(Entity(m.start(kind), m.end(kind), "secret" if kind == "access" else kind, value))
    if surnames:
        plain = all(_WORD.fullmatch(name) for name in surnames)      # then each mention is a whole word, found by lookup
        again = _WORD if plain else re.compile(r"\b(?:" + "|".join(map(re.escape, surnames)) + r")\b")
        taken = sorted((e.start, e.end) for e in found)
        starts = [a for a, _ in taken]
        for m in again.finditer(text):
            if m[0] in surnames:
                before = bisect.bisect_left(starts, m.end()) - 1      # the last entity that starts before the mention's end
                if before < 0 or taken[before][1] <= m.start():
                    found.append(Entity(m.start(), m.end(), surnames[m[0]], m[0].casefold()))
    return sorted(found, key=lambda e: e.start)


class Draw:
    """Numbers drawn from the key, an entity and the attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed = hashlib.blake2b(f"{kind}\0{value}\0{attempt}".encode("utf-8", "surrogatepass"), key=key[:64], digest_size=32).digest()
        self.stream = int.from_bytes(b"".join(hashlib.blake2b(self.seed + bytes([k])).digest() for k in range(4)), "big")

    def below(self, n: int) -> int:
        if self.stream < 1 << 64:
            self.seed = hashlib.blake2b(self.seed).digest()
            self.stream = int.from_bytes(self.seed, "big")
        self.stream, k = divmod(self.stream, n)
        return k

    def like(self, text: str) -> str:
        """Characters of the same kinds: digits, letters of the same script and case; others stay."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                letters = ALPHABETS[_script(c)]
                x = letters[self.below(len(letters))]
                out.append(x.upper() if c.isupper() else x)
            else:
                out.append(c)
        return "".join(out)


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The replacement of a normal form, itself a normal form of the kind."""
    d = Draw(key, kind, value, attempt)
    if kind == "email":
        local, _ = value.split("@", 1)
        return f"{d.like(local)}@{d.like('xxxx99xx')}.example"
    if kind == "ip":
        return ".".join([str(240 + d.below(16)), *[str(d.below(256)) for _ in range(3)]])
    if kind == "card":
        body = value[0] + d.like(value[1:-1])
        return body + str(_luhn(body))
    if kind == "ssn":
        return f"{900 + d.below(100)}{d.like(value[3:])}"
    if kind == "phone":
        lead = max(1, len(value) - 10) if len(value) > 10 else 0
        return value[:lead] + str(2 + d.below(8)) + d.like(value[lead + 1:])
    if kind == "iban":
        body = d.like(value[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    if kind == "secret":
        lead = _LEAD.match(value)[0]
        rest = value[len(lead):]
        new = "".join(SYMBOLS[d.below(len(SYMBOLS))] for _ in rest) if _plain(rest) else d.like(rest)
        return lead + new + d.like("x" * max(0, attempt - ROOM))
    what, script, *gender = kind.split(" ")
    if what == "given":
        names = GIVEN[script, gender[0]].split()
        name = names[d.below(len(names))].casefold()
        if attempt:                       # past the list: a second name tells them apart
            name += "-" + names[d.below(len(names))].casefold() + SYLLABLES[script].split()[d.below(8)] * (attempt - 1)
        return name
    parts, ends = SYLLABLES[script].split(), ENDINGS[script].split()
    name = "".join(parts[d.below(len(parts))] for _ in range(3 + attempt)) + ends[d.below(len(ends))]
    return name + "а" if script == "cyrillic" and value.endswith("а") and not name.endswith("й") else name


def dressed(shape: str, kind: str, new: str) -> str:
    """The surrogate in the mention's format: its separators, or its capitals."""
    if kind in ("card", "ssn", "phone", "iban"):
        left = iter(new)
        return "".join(next(left) if c.isalnum() else c for c in shape)
    if kind.startswith(("given", "surname")):
        return new.upper() if shape.isupper() and len(shape) > 1 else new.title()
    return new.upper() if kind == "email" and shape.isupper() else new


def replace(text: str, key: bytes, attempts: Mapping[tuple[str, str], int]) -> tuple[str, list[dict]]:
    """The text with every entity replaced, and what stands where in the new text."""
    found = detect(text)
    if not found:
        return text, []
    out, spans, at, size = [], [], 0, 0
    for e in found:
        new = dressed(text[e.start:e.end], e.kind, surrogate(e.kind, e.value, key, attempts.get((e.kind, e.value), 0)))
        out += [text[at:e.start], new]
        size += e.start - at + len(new)
        spans.append({"kind": e.kind.split(" ")[0], "start": size - len(new), "length": len(new)})
        at = e.end
    return "".join([*out, text[at:]]), spans


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (of, kind, value) of all whole texts; ``of`` is the text's hash."""
    schema = "of long, kind string, value string"

    def run(batches: Batches) -> Batches:
        for b in chunks(batches, "text", CHUNK_BYTES):
            of, found = b.column(0).to_pylist(), set()
            for k, t in zip(of, b.column(1).to_pylist(), strict=True):
                found.update((k, e.kind, e.value) for e in detect(t or ""))
            if found:
                cols = list(zip(*sorted(found), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])],
                                                 names=["of", "kind", "value"])

    return map_batches(docs.select(F.xxhash64(text).alias("of"), F.col(text).alias("text")), run, schema)


def _drawn(rows: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt) with the surrogate of that attempt."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(
                [surrogate(k, v, key, n) for k, v, n in zip(*cols, strict=True)], pa.string())],
                names=["kind", "value", "attempt", "new"])

    return map_batches(rows.select("kind", "value", "attempt"), run, "kind string, value string, attempt int, new string")


def assign(distinct: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt, new): one surrogate each, no two alike, none a real entity's form.

    All first draws are checked against each other and against the corpus's own
    entities by grouping and joins; whoever lost its surrogate draws again
    until none does.
    """
    real = distinct.select("kind", F.col("value").alias("new"))
    current = store(_drawn(distinct.select("kind", "value", F.lit(0).alias("attempt")), key), "surrogates")
    for _ in range(100):
        owners = current.groupBy("kind", "new").agg(F.count("*").alias("n"), F.min("value").alias("owner"))
        twice = current.join(owners.filter("n > 1"), ["kind", "new"]).filter("value <> owner")
        lost = store(twice.select("kind", "value").union(current.join(real, ["kind", "new"], "left_semi")
                                                         .select("kind", "value")).distinct(), "surrogates-lost")
        if lost.isEmpty():
            return current
        again = current.join(lost, ["kind", "value"], "left_semi").select(
            "kind", "value", (F.col("attempt") + 1).alias("attempt"))
        current = store(current.join(lost, ["kind", "value"], "left_anti").select(*current.columns)
                        .union(_drawn(again, key)), "surrogates")
    raise RuntimeError("surrogates still collide after 100 draws; their forms leave no room")


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text",
                 max_broadcast: int = MAX_BROADCAST) -> tuple[DataFrame, str]:
    """The rows with every detected entity of their whole texts replaced, and where
    (an array of kind, start, length in the new text; its column's name comes back too).

    A surrogate follows from the key and the entity's normal form alone, so all
    mentions in the corpus change alike; only the few entities that had to draw
    again after the collision checks are sent to tasks, or joined by text where
    they are many.  Null and empty texts and texts without entities stay as
    they are; repeated rows change alike; no rows give no rows.
    """
    found = store(entities(docs, text).distinct(), "entities")
    redrawn = assign(found.select("kind", "value").distinct(), key).filter("attempt > 0").select("kind", "value", "attempt")
    few = redrawn.limit(max_broadcast + 1).collect()
    name, own = free_name("entities", docs.columns), free_name("redrawn", docs.columns)
    spans = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                      T.StructField("length", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, spans)])
    width, spot, joined = len(docs.columns), docs.columns.index(text), len(few) > max_broadcast
    fixed = {} if joined else {(r["kind"], r["value"]): r["attempt"] for r in few}
    rows = docs
    if joined:
        of = free_name("of", docs.columns)
        lists = (found.join(redrawn, ["kind", "value"]).groupBy("of")
                 .agg(F.collect_list(F.struct("kind", "value", "attempt")).alias(own)).withColumnRenamed("of", of))
        rows = docs.withColumn(of, F.xxhash64(text)).join(lists, of, "left").select(*docs.columns, own)

    def run(batches: Batches) -> Batches:
        for b in chunks(batches, text, CHUNK_BYTES):
            texts, where = [], []
            extra = b.column(width).to_pylist() if joined else None
            for i, t in enumerate(b.column(spot).to_pylist()):
                known = {(x["kind"], x["value"]): x["attempt"] for x in extra[i] or []} if joined else fixed
                new, at = (t, []) if t is None else replace(t, key, known)
                texts.append(new)
                where.append(at)
            columns = b.columns[:width]
            columns[spot] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(where, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())])))], names=schema.names)

    return map_batches(rows, run, schema), name


def with_surrogates(docs: DataFrame, key: bytes = QUERY_KEY, text: str = "text") -> DataFrame:
    """The rows with their entities replaced, columns as they are."""
    return pseudonymise(docs, key, text)[0].select(*docs.columns)


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced, name = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), QUERY_KEY)
    return replaced.select("doc_id", "text", F.size(name).alias("n_entities"), F.col(name).alias("entities"))
