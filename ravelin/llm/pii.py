"""Personal data replaced by keyed surrogates of the same kind, format, script and gender."""

from __future__ import annotations

import hashlib
import re
import secrets
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import arrow_batches, slices, stored, table, temp, texts_of

#: Setting that holds the key of the surrogates. Without one every call draws its own, and nobody can compute them again.
KEY_SETTING = "spark.ravelin.surrogate.key"
#: Attempts at a surrogate that no other entity has; each leaves a small share of the entities open. From attempt WIDER on
#: short shapes grow, so that there are always free values.
ATTEMPTS, WIDER = 40, 8

#: Titles by gender, and given names by script and gender.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora"), "m": ("Mr", "Herr", "M", "Monsieur", "Sr", "Señor"), "": ("Dr", "Prof")}
GIVEN = {
    ("latin", "f"): "Alice Anna Clara Elena Emma Ines Julia Laura Lucy Maria Marta Nina Nora Olga Paula Rosa Sara Sofia Vera Zoe".split(),
    ("latin", "m"): "Adam Albert Anton Bruno Carl David Emil Felix Hugo Ivan Jan Leo Luis Marco Max Oscar Paul Peter Simon Tom".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Юлия".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Иван Максим Олег Павел Роман Юрий".split(),
}
#: Given names that tell a person besides those that surrogates are drawn from, by gender.
MORE_GIVEN = {
    "f": "Amanda Andrea Angela Barbara Beatriz Carmen Caroline Catherine Charlotte Christine Claudia Daniela Deborah Diana Elizabeth Emily Eva Francesca Gabriela Hannah Heidi Helen Ingrid Isabel Jane Jennifer Jessica Johanna Karen Katharina Kate Laurence Linda Lisa Lucia Margaret Marie Mary Melissa Michelle Monika Nadia Nancy Natalia Nicole Patricia Pilar Rachel Rebecca Ruth Sabine Sandra Sarah Sophie Stephanie Susan Teresa Ursula Victoria Анастасия Валентина Галина Екатерина Людмила Наталья Светлана Татьяна".split(),
    "m": "Alan Alejandro Alexander Andreas Andrew Antonio Benjamin Brian Carlos Charles Christian Daniel Diego Dieter Edward Eric Fernando Francisco Frank François George Hans Henry Jack Jacques James Javier Jean Johannes John Jonas Jorge Joseph José Juan Jürgen Karl Kevin Klaus Louis Lukas Manuel Mark Martin Matthew Michael Michel Miguel Nicolas Pablo Patrick Pedro Philippe Pierre Ralf Richard Robert Stefan Stephen Steven Thomas Timothy William Wolfgang Александр Алексей Андрей Владимир Дмитрий Михаил Николай Пётр Сергей".split(),
}
#: Syllables of surrogate family names.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo".split(),
    "cyrillic": "ба бе бо ва ве го да де ка ко ла ле ма ми на не по ра ре са со та те".split(),
}
_GENDER = {name: gender for gender, names in MORE_GIVEN.items() for name in names} | {name: gender for (_, gender), names in GIVEN.items() for name in names}

#: Words that begin sentences and are no part of a name though written with a capital; and words for places
#: and times, which are none behind a given name without a title (Victoria Park, but Mr Park).
NO_NAMES = (
    "After All An And As At Before But By Can Das Dem Den Der Des Die Ein Eine El En Er Es For From He Her Here His How If In Is It La Las Le Les Los No Not Now Of On Or Our She Sie So Thank That"
    " The Their Then There These They This Those To Today Un Una Und Une Was We Went What When Where Which Who Why Will With Yes You Your"
).split()
PLACES = (
    "April August Avenue Bridge Castle Church City College County Court December February Friday Garden Gardens Hall Hill Hospital House Island January July June Lake Lane March May Monday November October Park Place Rd Road"
    " River Saturday School September Square St Station Street Sunday Thursday Tower Tuesday University Valley Wednesday"
).split()
_UP, _LOW = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
_PART = rf"(?:(?:[DO]['’]|Ma?c)?[{_UP}][{_LOW}]+|[{_UP}]{{2,}})"
_WORD = rf"(?!(?:{'|'.join(NO_NAMES)})(?!\w)){_PART}(?:-{_PART})?"
_UNTITLED = rf"(?!(?:{'|'.join(PLACES)})(?!\w)){_WORD}"
_TITLE = "|".join(sorted((t for some in TITLES.values() for t in some), key=len, reverse=True))
_NAMES = "|".join(sorted(_GENDER, key=len, reverse=True))
#: Combining marks, which \w leaves out, and scripts written without blanks between words: there an address may touch
#: the text around it, so its parts are of such a script throughout or not at all.
_MARK = re.escape("".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M"))
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1100-\u11ff\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3130-\u318f\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff"
_LETTER, _LABEL = rf"[^\W{_DENSE}]", rf"(?:[^\W_{_DENSE}]|[{_MARK}-])+"
_MAIL = (
    rf"(?:(?<![._%+-])(?<!{_LETTER})(?<![{_MARK}]){_LETTER}(?:{_LETTER}|[{_MARK}.%+-])*|(?<![._%+{_DENSE}-])[{_DENSE}][{_DENSE}{_MARK}0-9._%+-]*)"
    rf"@(?:(?:{_LABEL}|[{_DENSE}{_MARK}0-9-]+)\.)+(?:xn--[A-Za-z0-9-]+|[^\W\d_{_DENSE}](?:[^\W\d_{_DENSE}]|[{_MARK}])+|[{_DENSE}][{_DENSE}{_MARK}]+)"
)
#: Kinds in order of precedence where matches overlap.
PATTERNS = (
    ("email", re.compile(_MAIL)),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)", re.ASCII)),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", re.ASCII)),
    ("card", re.compile(r"(?<![\w.+-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w-])", re.ASCII)),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII)),
    ("phone", re.compile(r"(?<![\w(+])(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\w)|(?<![\w.-])(?:\+?\d{1,2}[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])|(?<![\w(])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)", re.ASCII)),
    ("person", re.compile(rf"(?<!\w)(?:(?:{_TITLE})\b\.?[ ]{_WORD}(?:[ ]{_WORD})?|(?:{_NAMES})[ ]{_UNTITLED})(?!\w)")),
)
#: Every text with an entity matches this; the rest need no Python.
POSSIBLE = rf"[0-9@]|(?=[A-ZÀ-ÖØ-ÞА-ЯЁ])(?:{_TITLE}|{_NAMES})[. ]"


def detect(text: str) -> list[tuple[str, int, int]]:
    """Entities (kind, start, end) by start, without overlaps.

    A name of a person found in the text is an entity wherever else it stands alone, of the kind of its part (family or given).
    """
    found: list[tuple[str, int, int]] = []
    for kind, pattern in PATTERNS:
        if kind != "email" or "@" in text:
            found = _with_free(found, ((kind, *m.span()) for m in pattern.finditer(text)))
    names: dict[str, str] = {}
    for part, name, s, e in ((k, v, start + a, start + b) for kind, start, end in found if kind == "person" for k, v, a, b in parts(kind, text[start:end])):
        for shown in (name, text[s:e]):
            names[shown] = min(names.get(shown, part), part)  # family before given
    if names:
        listed = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
        found = _with_free(found, ((names[m.group()], *m.span()) for m in re.finditer(rf"(?<![\w@])(?:{listed})(?!\w)", text)))
    return found


def _with_free(taken: list[tuple[str, int, int]], more: Iterable[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans by start: `taken`, and those of `more` that overlap none of them."""
    starts = [s for _, s, _ in taken]
    free = []
    for kind, start, end in more:
        at = bisect_right(starts, start)
        if (not at or taken[at - 1][2] <= start) and (at == len(taken) or starts[at] >= end):
            free.append((kind, start, end))
    return sorted([*taken, *free], key=lambda x: x[1]) if free else taken


def _script(word: str) -> str:
    return "cyrillic" if re.search("[А-Яа-яЁё]", word) else "latin"


def _name(word: str) -> str:
    """A name as it is compared: all capitals as the first of each part."""
    return "-".join(p.capitalize() for p in word.split("-")) if word.isupper() else word


def _bare(text: str) -> str:
    return re.sub(r"[^0-9A-Za-z]", "", text)


def _lower(text: str) -> str:
    """In lower case, letter by letter, so that the length stays."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def parts(kind: str, text: str) -> list[tuple[str, str, int, int]]:
    """What a surrogate is chosen for: (kind, canonical value, start, end) inside an entity's text.

    A person is a given and a family name, each with a surrogate of its own, so that "Mr Weber" and "Paul Weber" agree.
    """
    if kind == "email":
        return [("email", _lower(text), 0, len(text))]
    if kind != "person":
        return [(kind, _bare(text), 0, len(text))]
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^ ]+", text)]
    title = words[0][0].rstrip(".")
    gender = next((g for g, titles in TITLES.items() if title in titles), None)
    names = words if gender is None else words[1:]
    out = []
    for place, (word, start, end) in enumerate(names):
        if place == len(names) - 1:
            out.append((f"family:{_script(word)}", _name(word), start, end))
        else:
            out.append((f"given:{_script(word)}:{gender or _GENDER.get(_name(word), 'm')}", _name(word), start, end))
    return out


class _Stream:
    """Keyed pseudo-random numbers for an entity and an attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int) -> None:
        self.seed, self.key, self.block, self.at, self.count = f"{kind}\n{value}\n{attempt}".encode("utf-8", "surrogatepass"), key[:64], b"", 0, 0

    def below(self, n: int) -> int:
        if self.at + 4 > len(self.block):
            self.block = hashlib.blake2b(self.seed + self.count.to_bytes(4, "little"), key=self.key).digest()
            self.at, self.count = 0, self.count + 1
        value = int.from_bytes(self.block[self.at : self.at + 4], "little")
        self.at += 4
        return value % n


def _luhn(digits: str) -> int:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (2 if place % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10


@lru_cache(maxsize=4096)
def _kin(block: int) -> str:
    """Letters in lower case, or without case, among the 128 characters of a block; a-z for Latin ones."""
    near = [chr(c) for c in range(block * 128, block * 128 + 128)] if block > 4 else []
    return "".join(c for c in near if c.isalpha() and c.lower() == c and len(c.upper()) == 1 and c.upper().lower() == c) or "abcdefghijklmnopqrstuvwxyz"


def _alike(text: str, stream: _Stream) -> str:
    """Another character of the same class for each letter and digit; a leading digit is never 0."""
    out = []
    for place, ch in enumerate(text):
        if ch.isdigit():
            out.append(str(1 + stream.below(9) if place == 0 else stream.below(10)))
        elif "a" <= ch <= "z":
            out.append(chr(97 + stream.below(26)))
        elif "A" <= ch <= "Z":
            out.append(chr(65 + stream.below(26)))
        elif ch.isalpha():
            kin = _kin(ord(ch) // 128)
            out.append(kin[stream.below(len(kin))])
        else:
            out.append(ch)
    return "".join(out)


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """A canonical value of the same kind and shape, fixed by the key, the value and the attempt."""
    stream, more = _Stream(key, kind, value, attempt), max(0, attempt - WIDER + 1)
    if kind == "email":
        local, _, domain = value.partition("@")
        local += "x" * (2 * more)
        labels = domain.split(".")
        return _alike(local, stream) + "@" + ".".join([*(_alike(x, stream) for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        ranges = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        spans = [(1, 254) if more else ranges[len(octet)] for octet in value.split(".")]
        return ".".join(str(low + stream.below(high - low + 1)) for low, high in spans)
    if kind == "card":
        made = _alike(value, stream)
        valid = _luhn(value) == 0
        for last in range(10):
            if (_luhn(made[:-1] + str(last)) == 0) == valid:
                return made[:-1] + str(last)
    if kind == "phone" and len(value) == 11 and value[0] == "1":  # the country code says where, not who
        return "1" + _alike(value[1:], stream)
    if kind == "phone" and len(value) < 9:
        return _alike(value + "0" * more, stream)
    if kind == "iban":
        return value[:2] + _alike(value[2:], stream)
    if kind.startswith("given"):
        _, script, gender = kind.split(":")
        names = GIVEN[script, gender]
        return names[stream.below(len(names))] + "".join(SYLLABLES[script][stream.below(len(SYLLABLES[script]))] for _ in range(min(attempt, 3) + more))
    if kind.startswith("family"):
        syllables = SYLLABLES[kind.split(":")[1]]
        return "".join(syllables[stream.below(len(syllables))] for _ in range(max(3, min(6, len(value) // 2)) + attempt // 4)).capitalize()
    return _alike(value, stream)


def _poured(kind: str, shown: str, chosen: str) -> str:
    """The surrogate in the format in which the entity is shown."""
    if kind == "email":
        local, _, domain = shown.partition("@")
        padded = local + "x" * (chosen.index("@") - len(local)) + "@" + domain  # the local part may have grown
        return "".join(c.upper() if s.isupper() and len(c.upper()) == 1 else c for s, c in zip(padded, chosen, strict=True))
    if kind.startswith(("given", "family")):
        return chosen.upper() if shown.isupper() else chosen
    if kind == "ip":
        return chosen
    left = iter(chosen)
    return "".join(next(left) if re.match("[0-9A-Za-z]", ch) else ch for ch in shown) + "".join(left)


def _canonical(kind: str, text: str) -> list[tuple[str, str, int, int]]:
    if kind.startswith(("family", "given")):
        return [(kind, _name(text), 0, len(text))]
    return [(kind, text, 0, len(text))] if kind == "ip" else parts(kind, text)


_NODE, _MAP = temp("node"), temp("surrogates")
_FOUND = pa.schema([("node", pa.binary()), ("kind", pa.string()), ("value", pa.string())])


def _occurrences(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows: dict[str, list] = {f.name: [] for f in _FOUND}
            for node, value in zip(part.column(_NODE).to_pylist(), texts_of(part, text), strict=True):
                seen = {(k, v) for kind, s, e in detect(value) for k, v, _, _ in _canonical(kind, value[s:e])}
                for kind, entity in sorted(seen):
                    for name, x in zip(rows, (node, kind, entity), strict=True):
                        rows[name].append(x)
            yield arrow_batches(rows, _FOUND)

    return run


def _candidates(key: bytes, attempt: int):
    out = pa.schema([("kind", pa.string()), ("value", pa.string()), ("surrogate", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            kinds, values = part.column("kind").to_pylist(), part.column("value").to_pylist()
            yield arrow_batches({"kind": kinds, "value": values, "surrogate": [surrogate(k, v, attempt, key) for k, v in zip(kinds, values, strict=True)]}, out)

    return run


def surrogate_key(spark: SparkSession) -> bytes:
    """The key of KEY_SETTING, or a new one."""
    setting = spark.conf.get(KEY_SETTING, None)
    return setting.encode() if setting else secrets.token_bytes(32)


def choose_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value): no two of a kind share one, and none is an entity of the table.

    Each attempt draws a candidate for every open entity; it is kept unless it is an original, was kept before, or is
    drawn by an entity with a lesser value too. The rest try again. Every attempt works on the open entities only.
    """
    originals = stored(entities.select("kind", "value").distinct(), "entities")
    open_ones, kept = originals, None
    for attempt in range(ATTEMPTS):
        drawn = open_ones.mapInArrow(_candidates(key, attempt), "kind string, value string, surrogate string")
        free = drawn.join(originals.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if kept is not None:
            free = free.join(kept.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        new = stored(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate"), "surrogates")
        kept = new if kept is None else kept.unionAll(new)
        open_ones = stored(open_ones.join(new.select("kind", "value"), ["kind", "value"], "left_anti"), "open")
        if open_ones.isEmpty():
            return kept
    raise RuntimeError(f"entities are left without a surrogate of their own after {ATTEMPTS} attempts")


def replace(text: str, chosen: Callable[[str, str], str]) -> tuple[str, int]:
    """`text` with every entity's parts replaced, and the number of entities."""
    out, at, entities = [], 0, detect(text)
    for kind, start, end in entities:
        for part, value, s, e in _canonical(kind, text[start:end]):
            out += [text[at : start + s], _poured(part, text[start + s : start + e], chosen(part, value))]
            at = start + e
    return "".join([*out, text[at:]]), len(entities)


def _rewrite(kept: list[str], text: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts, counts = [], []
            for value, rows in zip(part.column(text).to_pylist(), part.column(_MAP).to_pylist(), strict=True):
                chosen = {(r["kind"], r["value"]): r["surrogate"] for r in rows or ()}
                new, count = (None, 0) if value is None else replace(value, lambda k, v, c=chosen: c[k, v])
                texts.append(new)
                counts.append(count)
            columns = [pa.array(texts, pa.string()) if c == text else part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int32())], names=[*kept, name])

    return run


def replace_pii(docs: DataFrame, key: bytes, text: str = "text", count: str = "n_entities") -> DataFrame:
    """`docs` with personal data in `text` replaced, and the number of places in the column `count`.

    Emails, IP addresses, account and card numbers, phone numbers and named persons are found by pattern. Their distinct
    canonical values get surrogates from a keyed hash: letters for letters, digits for digits, check digits kept valid,
    separators and case as shown, given names of the same gender and script. One value has one surrogate everywhere,
    different values have different ones, and no surrogate is an original of the corpus. Texts that cannot hold an entity
    do not move. The others meet their own few surrogates by a hash of the text, so copies share one list.

    A null text stays null with no entities, an empty one empty; a long one is read whole in time that grows with its
    length. Repeated rows and other columns pass through; an empty table gives an empty one; a column called `count` is
    replaced. The same key gives the same surrogates for the same table.
    """
    docs = docs.drop(count).withColumn(text, F.col(f"`{text}`").cast("string"))
    possible = F.coalesce(F.col(text).rlike(POSSIBLE), F.lit(False))
    kept = docs.columns
    clean = docs.where(~possible).withColumn(count, F.lit(0))
    rows = docs.where(possible).withColumn(_NODE, F.unhex(F.md5(F.col(text).cast("binary"))))
    found = stored(rows.select(_NODE, text).mapInArrow(_occurrences(text), "node binary, kind string, value string").distinct(), "occurrences")
    chosen = choose_surrogates(found, key)
    lists = found.join(chosen, ["kind", "value"]).groupBy("node").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias(_MAP))
    joined = rows.join(lists.withColumnRenamed("node", _NODE), _NODE, "left").drop(_NODE)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return clean.unionByName(joined.mapInArrow(_rewrite(kept, text, count), f"{schema}, `{count}` int"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return replace_pii(table(spark, folder, "documents").select("doc_id", "text"), surrogate_key(spark))
