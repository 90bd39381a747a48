"""Personal data replaced by surrogates.

Method. Entities are found by pattern: e-mail addresses, telephone, card (with a right check digit), account and social security numbers, network
addresses, secrets, and personal names behind a title or with a known given name. Each gets a surrogate of its kind from a
keyed hash: digits for digits and letters for letters in the same layout and case; given names of the same gender
and script, surnames of the same script, put together from syllables so that there are far more of them than a corpus has. The same entity has the same surrogate in all documents, however it is
laid out, so that references to it still agree. Over the whole corpus no two entities of a kind may share a surrogate, and none may
be an entity that occurs: those that collide are drawn anew, under a new attempt number, until no collision is left. Layouts may have fewer
surrogates than entities ("_@a.org" has one), so later attempts are longer or wider, and the rounds end. Cards and IPv4 addresses keep their
length: they have more surrogates than any corpus has entities.

Cost. The texts are read twice: once for the distinct entities, which are checked as a table, and once to replace. First attempts follow from the key. Where there are later ones, the texts
are read once more for whom they concern, and meet their attempts by a join on the text's hash. A round writes only the entities that are still open. Nothing comes to the driver.

Names are replaced part by part, so that "Mrs Ann Lee" and "Mrs Lee" remain one family.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import annotate, fresh, write_shared

# Given names for detection and replacement, by gender and script.
FEMALE_LATIN = (
    "Alice", "Anna", "Barbara", "Carla", "Clara", "Diana", "Elena", "Emily", "Eva", "Hannah", "Helen", "Ingrid", "Irene", "Julia", "Karen", "Laura",
    "Linda", "Lucy", "Maria", "Martha", "Mary", "Nina", "Olivia", "Paula", "Rosa", "Sarah", "Sofia", "Susan", "Teresa", "Vera",
)
MALE_LATIN = (
    "Adam", "Albert", "Andrew", "Carlos", "Daniel", "David", "Edward", "Felix", "Frank", "George", "Hans", "Henry", "Hugo", "James", "Jean", "John",
    "Jorge", "Karl", "Louis", "Luis", "Mark", "Martin", "Michael", "Oscar", "Otto", "Paul", "Peter", "Robert", "Thomas", "William",
)
FEMALE_CYRILLIC = (
    "Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лариса", "Мария", "Нина", "Ольга", "Софья", "Татьяна",
)
MALE_CYRILLIC = (
    "Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Игорь", "Максим", "Николай", "Олег", "Павел", "Сергей", "Юрий",
)
#: Beginnings, vowels, consonants and ends of made-up names, by script and for what they are.
SYLLABLES = {
    "latin": (("al", "bar", "ber", "bran", "cal", "dal", "dor", "fal", "fen", "gar", "gren", "hal", "kel", "lan", "lor", "mar", "mel", "nor", "pel", "ren", "sal", "tor", "val", "wes"),
              ("a", "e", "i", "o", "u", "ai", "ei", "ou"), ("b", "d", "f", "g", "k", "l", "m", "n", "r", "s", "t", "v")),
    "cyrillic": (("ал", "бар", "бел", "вол", "гор", "гран", "дор", "жар", "зор", "кал", "лен", "мар", "нев", "пол", "рад", "сав", "тар", "хол", "чер", "яр"),
                 ("а", "е", "и", "о", "у", "ы"), ("б", "в", "г", "д", "к", "л", "м", "н", "р", "с", "т", "х")),
}
ENDS = {
    ("surname", "", "latin"): ("berg", "dale", "ert", "ez", "hart", "ing", "ley", "mann", "ner", "son", "stein", "ton"), ("surname", "", "cyrillic"): ("ов", "ев", "ин", "ский", "енко", "ович"),
    ("given", "f", "latin"): ("a", "ina", "elle", "ia", "ette"), ("given", "m", "latin"): ("o", "us", "an", "ert", "in"),
    ("given", "f", "cyrillic"): ("ана", "ина", "ия", "ова"), ("given", "m", "cyrillic"): ("ан", "ий", "ор", "слав"),
}
FEMALE_TITLES = (
    "Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme",
)
MALE_TITLES = (
    "Mr", "Herr", "Señor", "Sr", "Monsieur",
)
OTHER_TITLES = ("Dr", "Prof")

GIVEN = {("f", "latin"): FEMALE_LATIN, ("m", "latin"): MALE_LATIN, ("f", "cyrillic"): FEMALE_CYRILLIC, ("m", "cyrillic"): MALE_CYRILLIC}
_GENDER = {n: gender for (gender, _), names in GIVEN.items() for n in names}

_TITLE = "|".join([*FEMALE_TITLES, *MALE_TITLES, *OTHER_TITLES])
_GIVEN = "|".join(_GENDER)
_NAME = r"[A-ZÀ-ÞА-Я][\w'’-]*[a-zß-ÿа-я]"
_PATTERNS = {
    "email": r"(?<![\w.+-])[\w][\w.+-]*@[a-zA-Z0-9][a-zA-Z0-9-]*(?:\.[a-zA-Z0-9-]+)+",
    "secret": r"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b\s*[:=]\s*[\"']?)(?P<value>[\w/+.=-]{8,}\b)"
              r"|\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-fA-F]{32,128})\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)|\b(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}\b",
    "card": r"(?<!\d)\d{4}(?:[ -]?\d{4}){3}(?!\d)|(?<!\d)3[47]\d{2}[ -]?\d{6}[ -]?\d{5}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
             r"|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)",
    "name": rf"\b(?:(?P<title>{_TITLE})\b\.? (?P<one>{_NAME})(?: (?P<two>{_NAME}))?|(?P<given>{_GIVEN}) (?P<sur>{_NAME}))",
}
_FINDERS = {kind: re.compile(p) for kind, p in _PATTERNS.items()}
#: What a text must have for a kind to be in it.
_NEEDS = {"email": re.compile("@"), "secret": re.compile(r"(?i)token|secret|passw|key|[0-9a-f]{32}|AKIA|gh[pousr]_"),
          "ip": re.compile(r"\d|[a-fA-F]:[a-fA-F]"),
          "name": re.compile(rf"\b(?:{_TITLE}|{_GIVEN})\b")}
_DIGIT = re.compile(r"\d")
#: Texts without any of this hold no entity; told by a linear scan. In RE2 \b knows ASCII words only, so it stands before Latin letters alone,
#: where it holds wherever Python's does. Addresses and keys may be letters throughout.
_HINT = (rf"[\p{{Nd}}@]|(?i:token|secret|passw|key)|AKIA|gh[pousr]_|[a-fA-F]{{32}}|(?:[a-fA-F]{{1,4}}:){{7}}"
         rf"|\b(?:{_TITLE})\.? |\b(?:{'|'.join([*FEMALE_LATIN, *MALE_LATIN])}) |(?:{'|'.join([*FEMALE_CYRILLIC, *MALE_CYRILLIC])}) ")
#: Kinds whose entities are their letters and digits, however laid out.
_SPACED = {"card", "ssn", "phone", "iban"}


class Entity(NamedTuple):
    start: int
    end: int
    kind: str
    canonical: str


def _script(word):
    return "cyrillic" if re.match(r"[Ѐ-ӿ]", word) else "latin"


def _name_parts(m):
    """(span group, kind) of the parts of a name."""
    title, groups = m["title"], [g for g in ("one", "two", "given", "sur") if m[g]]
    gender = "f" if title in FEMALE_TITLES else "m" if title in MALE_TITLES else ""
    for g in groups:
        word = m[g]
        if g == "given" or (g == "one" and m["two"]):
            yield g, f"given-{_GENDER.get(word, gender) or 'f'}-{_script(word)}"
        else:
            yield g, f"surname--{_script(word)}"


def entities(text: str) -> list[Entity]:
    """The entities of a text, in order. Where two overlap, the kind that comes first among the patterns counts."""
    out, taken = [], []
    for kind, finder in _FINDERS.items():
        if not _NEEDS.get(kind, _DIGIT).search(text):
            continue
        for m in finder.finditer(text):
            start, end = m.span("value") if kind == "secret" and m["value"] else m.span()
            if any(start < e and s < end for s, e in taken):
                continue
            if kind == "card" and _luhn(re.sub(r"\D", "", text[start:end])):
                continue  # some other number
            taken.append((start, end))
            if kind == "name":
                out += [Entity(*m.span(g), k, m[g].lower()) for g, k in _name_parts(m)]
            else:
                found = text[start:end]
                out.append(Entity(start, end, kind, re.sub(r"\W|_", "", found).lower() if kind in _SPACED else found.lower()))
    return sorted(out)


def _stream(key: bytes, kind: str, canonical: str, attempt: int):
    """Numbers below 2**32 without end, from the key and the entity."""
    n = 0
    while True:
        block = hmac.new(key, f"{kind}\x1f{canonical}\x1f{attempt}\x1f{n}".encode("utf-8", "replace"), hashlib.sha256).digest()
        yield from (int.from_bytes(block[i : i + 4], "big") for i in range(0, 32, 4))
        n += 1


def _alike(text, draw, letters="abcdefghijklmnopqrstuvwxyz"):
    """Digits for digits, letters for letters; the rest stays."""
    return "".join(str(next(draw) % 10) if c.isdigit() else letters[next(draw) % len(letters)] if c.isalpha() else c for c in text)


def _luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def _made_name(part, gender, script, draw, attempt):
    """A given name from the list, from the second attempt on with a made-up one behind it; a made-up surname. Later attempts are longer."""
    pick = lambda choices: choices[next(draw) % len(choices)]
    first, vowels, consonants = SYLLABLES[script]
    listed = f"{pick(GIVEN[gender, script]).lower()}-" if part == "given" else ""
    if listed and not attempt:
        return listed[:-1]
    middle = "".join(pick(vowels) + pick(consonants) for _ in range(2 + attempt // 2))
    return f"{listed}{pick(first)}{middle}{pick(ENDS[part, gender, script])}"


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The stand-in for an entity, in canonical form."""
    draw = _stream(key, kind, canonical, attempt)
    more = (attempt + 1) // 2  # the layout's surrogates may be used up
    if kind.startswith(("given-", "surname-")):
        return _made_name(*kind.split("-"), draw, attempt)
    if kind == "email":
        local, _, domain = canonical.partition("@")
        *hosts, _, top = domain.split(".")
        return ".".join([f"{_alike(local + 'a' * more, draw)}@" + "".join(f"{_alike(h, draw)}." for h in hosts) + "example", top])
    if kind == "ip":
        if ":" in canonical:
            if more > 1:
                return ":".join(f"{next(draw) % 65536:x}" for _ in range(8))
            return _alike(re.sub("[a-f]", "0", canonical), draw)
        return ".".join(str(1 + next(draw) % 254) for _ in range(4))
    if kind == "phone":
        keep = 1 if len(canonical) > 10 else 0
        return canonical[:keep] + _alike(canonical[keep:] + "0" * (more // 2), draw)
    if kind == "iban":
        return canonical[:2] + _alike(canonical[2:] + "0" * (more // 2), draw)
    if kind == "ssn":
        return _alike(canonical + "0" * (more // 2), draw)
    if kind == "card":
        made = _alike(canonical, draw)
        if _luhn(canonical) == 0:
            made = next(made[:-1] + str(d) for d in range(10) if _luhn(made[:-1] + str(d)) == 0)
        return made
    prefix = re.match(r"akia(?=\w{16}$)|gh[pousr]_(?=\w{36}$)|", canonical)[0]  # says what kind of secret it is
    hexadecimal = re.fullmatch("[0-9a-f]+", canonical) is not None
    return prefix + _alike(canonical[len(prefix) :] + "a" * more, draw, "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz")


def laid_out(kind: str, original: str, stand_in: str) -> str:
    """`stand_in` in the layout and case of `original`."""
    if kind in _SPACED:
        letters = iter(stand_in)
        made = "".join(next(letters, "") if c.isalnum() else c for c in original) + "".join(letters)
    elif kind.startswith(("given-", "surname-")):
        made = "-".join(part.capitalize() for part in stand_in.split("-"))
    elif len(original) == len(stand_in) or kind == "secret":
        made = "".join(s.upper() if c.isupper() else s for c, s in zip(original, stand_in)) + stand_in[len(original) :]
        return made.upper() if original.isupper() else made
    else:
        made = stand_in
    return made.upper() if original.isupper() else made


def _found(text):
    return entities(text) if text else []


def _hinted(texts):
    """The texts as strings, None where no entity can be."""
    texts = pc.fill_null(texts, "")
    maybe = pc.match_substring_regex(texts, _HINT)
    return [t.as_py() if m.as_py() else None for t, m in zip(texts, maybe)]


def corpus_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct (kind, canonical) of all texts."""
    result = T.StructType([T.StructField("kind", T.StringType()), T.StructField("canonical", T.StringType())])

    def run(stream):
        for batch in stream:
            pairs = {(e.kind, e.canonical) for t in _hinted(batch.column(0)) for e in _found(t)}
            yield pa.RecordBatch.from_pylist([{"kind": k, "canonical": c} for k, c in pairs], pa.schema([("kind", pa.string()), ("canonical", pa.string())]))

    return docs.select(text).mapInArrow(run, result).distinct()


def assigned(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt, surrogate) with no surrogate twice in a kind and none that is itself in `found`.

    Of those that draw the same the first by its canonical form keeps it. A round judges the entities still open against each other, what is settled and what occurs, and writes
    what it settles and what stays open.
    """
    @F.pandas_udf(T.StringType())
    def drawn(kind: pd.Series, canonical: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, c, a) for k, c, a in zip(kind, canonical, attempt)], dtype=object)

    found = write_shared(found, "pii-found")
    occurs = found.select("kind", F.col("canonical").alias("surrogate"))
    settled, current, attempt = None, found.select("kind", "canonical"), 0
    while True:
        tried = write_shared(current.withColumn("attempt", F.lit(attempt)).withColumn("surrogate", drawn("kind", "canonical", "attempt")), "pii-drawn")
        taken = (occurs if settled is None else occurs.unionByName(settled.select("kind", "surrogate"))).distinct().withColumn("taken", F.lit(True))
        first = tried.groupBy("kind", "surrogate").agg(F.min("canonical").alias("holder"))
        judged = tried.join(first, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        again = (F.col("canonical") != F.col("holder")) | F.coalesce("taken", F.lit(False))
        judged = write_shared(judged.select("kind", "canonical", "attempt", "surrogate", again.alias("again")), "pii-judged")
        done = judged.where("not again").drop("again")
        settled = done if settled is None else settled.unionByName(done)
        current, attempt = judged.where("again").select("kind", "canonical"), attempt + 1
        if current.isEmpty():
            return settled


def text_attempts(docs: DataFrame, later: DataFrame, text: str = "text") -> DataFrame:
    """(text_hash, attempts): for every text of `docs` that holds some of `later` (kind, canonical, attempt), the attempt of each of them.

    A text is one row however often it occurs; its own entities bound its map.
    """
    result = T.StructType([T.StructField("text_hash", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("canonical", T.StringType())])

    def run(stream):
        for batch in stream:
            rows = {(h, e.kind, e.canonical) for h, t in zip(batch.column(0).to_pylist(), _hinted(batch.column(1))) for e in _found(t)}
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((), (), ()), (pa.int64(), pa.string(), pa.string()))], names=result.fieldNames())

    held = docs.select(F.xxhash64(text), text).mapInArrow(run, result).distinct()
    entry = F.struct(F.concat_ws("\x1f", "kind", "canonical").alias("key"), F.col("attempt").alias("value"))
    return held.join(later, ["kind", "canonical"]).groupBy("text_hash").agg(F.map_from_entries(F.collect_list(entry)).alias("attempts"))


RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))])


def with_surrogates(docs: DataFrame, name: str, key: bytes, text: str = "text") -> DataFrame:
    """`docs` with struct `name`: the text with surrogates, and the kind of each entity in order.

    `key` is a secret of the user's: who has it can tell which entity a surrogate may stand for. A null text stays null and an empty one empty; texts without entities stay as
    they are; texts of any length are read whole. Rows that repeat are replaced alike.
    """
    later = write_shared(assigned(corpus_entities(docs, text), key).where("attempt > 0").select("kind", "canonical", "attempt"), "pii-later")
    columns, extra = docs.columns, []
    if not later.isEmpty():
        (hashed, attempts) = fresh(docs, "text_hash", "attempts")
        concerned = write_shared(text_attempts(docs, later, text), "pii-attempts").toDF(hashed, attempts)
        docs, extra = docs.withColumn(hashed, F.xxhash64(text)).join(concerned, hashed, "left"), [attempts]

    def prepare():
        def replaced(text, attempts):
            out, at, kinds = [], 0, []
            for e in _found(text):
                stand_in = surrogate(key, e.kind, e.canonical, attempts.get(f"{e.kind}\x1f{e.canonical}", 0))
                out += [text[at : e.start], laid_out(e.kind, text[e.start : e.end], stand_in)]
                at = e.end
                kinds.append(e.kind.split("-")[0])
            return "".join([*out, text[at:]]), kinds

        def work(texts, attempts=None):
            made, kinds = [], []
            for k, t in enumerate(_hinted(texts)):
                given = dict(attempts[k].as_py() or ()) if attempts is not None else {}
                new, of = replaced(t, given) if t is not None else (texts[k].as_py(), [])
                made.append(new if texts[k].is_valid else None)
                kinds.append(of)
            return pa.StructArray.from_arrays([pa.array(made, pa.string()), pa.array(kinds, pa.list_(pa.string()))], ["text", "kinds"])

        return work

    return annotate(docs, [text, *extra], RESULT, name, prepare).select(*columns, name)


def anonymised(docs: DataFrame, key: bytes, text: str = "text", key_column: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, text, n_entities, and kinds, the distinct kinds replaced, sorted. Nulls, empty, long and repeated texts as in `with_surrogates`;
    other columns are not read. An empty table gives an empty result."""
    slim = docs.select(F.col(key_column).alias("doc_id"), F.col(text).alias("text"))
    return with_surrogates(slim, "made", key, "text").select(
        "doc_id", "made.text", F.size("made.kinds").cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct("made.kinds")), ",").alias("kinds"))


def anonymised_documents(docs: DataFrame, key: bytes, text: str = "text", length: str = "n_chars") -> DataFrame:
    """`docs` with the text replaced, and its length in code points where there is a column for it; all rows and columns stay, whatever their nulls, and an empty table gives an
    empty one."""
    (name,) = fresh(docs, "made")
    made = with_surrogates(docs, name, key, text)
    new = {text: F.col(f"{name}.text"), length: F.char_length(f"{name}.text").cast("long")}
    return made.select([new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
