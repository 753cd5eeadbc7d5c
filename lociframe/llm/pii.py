"""Personal data replaced by surrogates that keep type, format, script and gender.

Each kind of entity has a finite domain of its own format, such as all digit strings of a phone number's length, and
a keyed permutation P of that domain: a Feistel network over the entity's rank, walked on until it is in the domain.
The surrogate is P^-1(P(x) + 1): the same original always gets the same surrogate (coreference), two originals never
share one (distinctness), and none keeps its own value. Checks against collisions: a surrogate that leaves its
class (a valid address, a known name) is walked on until it is in it; each document's map is checked for
one-to-one before it is used; collisions() checks a whole corpus.

Entities are brought to one form before they are permuted, so spellings of one entity get spellings of one surrogate: a phone
number goes by its country and digits, a name by its words, whatever honorific stands before it. Names are found after honorifics, and
each word of a found name is replaced wherever it stands in the document as a word. Given names of the list below are permuted within
their gender and script; other names keep length, case, script and ending, vowels go to vowels and consonants to consonants.

The key is a secret that the caller gives: who has it can turn surrogates back. query_key() takes it from
spark.lociframe.surrogate.key, or else makes a random one for the session.

Defined cases: a null text stays null with no entities; empty texts and texts without entities stay as they are; repeated
rows get equal results; texts of any length are read in full; an empty table gives no rows; other columns stay, and if one is named
entities, the added one gets underscores until its name is free.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociframe.llm import shared

KEY_CONF = "spark.lociframe.surrogate.key"
ROUNDS = 8

# Country codes of one and two digits (all others have three), honorifics by gender, given names by gender and script, vowels and consonants by script.
COUNTRY_1 = "1 7".split()
COUNTRY_2 = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
HONORIFICS = {"f": "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Mlle|Signora|Doña|госпожа|г-жа", "m": "Mr|Herr|Señor|Sr|Monsieur|Signor|Don|господин|г-н", "n": "Dr|Prof"}
GIVEN = {
    ("f", "latin"): "Anna Berta Clara Diana Elena Franca Greta Helena Irene Julia Karla Laura Maria Nina Olga Paula Rosa Sara Teresa Vera".split(),
    ("m", "latin"): "Adam Boris Carlos David Erik Felix Georg Hugo Ivan Jakob Karl Lukas Martin Nils Oskar Peter Robert Simon Tomas Viktor".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Лариса Мария Надежда Ольга Полина Светлана".split(),
    ("m", "cyrillic"): "Алексей Борис Виктор Григорий Дмитрий Егор Иван Константин Леонид Михаил Николай Павел".split(),
}
ALPHABETS = ("aeiouy", "bcdfghjklmnpqrstvwxz", "áéíóúàèìòùâêîôûäëïöü", "çñß", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъьы", "αεηιουω", "βγδζθκλμνξπρστφχψς", "0123456789")
HAN = range(0x4E00, 0x9FA6)

_CLASS = {c: a for a in ALPHABETS for c in dict.fromkeys(a)}
_CLASS["ы"] = ALPHABETS[4]
_KNOWN = {n: (g, s) for (g, s), names in GIVEN.items() for n in names}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_EMAIL = re.compile(r"@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-.")
_NUMBERS = re.compile(
    rf"""(?<![\w.])(?=[\d+(])(?:
    (?P<ip>{_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d))
    |(?P<phone>\+\d{{1,3}}[ .-]?\(\d{{1,4}}\)[ .-]?\d{{3}}[ .-]?\d{{4}}|\(\d{{3}}\)[ .-]?\d{{3}}[ .-]\d{{4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}|\+\d{{1,3}}(?:[ .-]\d{{2,5}}){{2,5}}|\+\d{{8,15}})
    |(?P<ssn>\d{{3}}-\d{{2}}-\d{{4}})
    |(?P<card>\d{{4}}(?P<sep>[ -])\d{{4}}(?P=sep)\d{{4}}(?P=sep)\d{{4}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}}|\d{{13,19}})
    )(?![\w-])""",
    re.VERBOSE,
)
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_SECRET = re.compile(r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)|(?<!\w)gh[pousr]_[A-Za-z0-9]{20,}|(?<!\w)sk-[A-Za-z0-9]{20,}|(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b[\"']?\s*[=:]\s*[\"']?)(?P<v>[A-Za-z0-9_\-/+]{8,})")
_CASED = r"[A-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω][a-zß-öø-ÿа-яёά-ώ]+"
_WORD = rf"(?:{_CASED}(?:-{_CASED})*|[\u4e00-\u9fa5]{{1,4}})"
_NAME = {g: re.compile(rf"(?<!\w)(?:{h})\.? ({_WORD}(?: {_WORD})?)(?!\w)") for g, h in HONORIFICS.items()}


class Permutation:
    """Keyed permutation of range(m) without fixed points, for m over 1."""

    def __init__(self, m: int, key: str, tweak: str):
        self.m = m
        bits = max(2, (m - 1).bit_length())
        self.half = (bits + 1) // 2
        self.mask = (1 << self.half) - 1
        self.seed = hashlib.blake2b(f"{tweak}\0{m}".encode(), key=hashlib.sha256(key.encode()).digest(), digest_size=32).digest()

    def _f(self, i: int, x: int) -> int:
        n = (self.half + 7) // 8
        out = b""
        while len(out) < n:
            out += hashlib.blake2b(x.to_bytes(n + 1, "little") + bytes([i, len(out) % 251]), key=self.seed, digest_size=32).digest()
        return int.from_bytes(out[:n], "little") & self.mask

    def _once(self, x: int, back: bool) -> int:
        left, right = x >> self.half, x & self.mask
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            left, right = (right ^ self._f(i, left), left) if back else (right, left ^ self._f(i, right))
        return left << self.half | right

    def _walk(self, x: int, back: bool) -> int:
        x = self._once(x, back)
        while x >= self.m:
            x = self._once(x, back)
        return x

    def __call__(self, x: int) -> int:
        return self._walk((self._walk(x, False) + 1) % self.m, True) if self.m > 1 else x


def _until(step: Callable, x, same: Callable):
    """Walk on while the outcome is not in the same class as x; stays a permutation of that class."""
    want, out = same(x), step(x)
    while same(out) != want:
        out = step(out)
    return out


def _alphabet(c: str) -> str | range | None:
    return _CLASS.get(c.lower()) or (HAN if ord(c) in HAN else None)


def permute_letters(text: str, key: str, tweak: str, fixed: Callable[[int], bool] = lambda i: False) -> str:
    """Each letter and digit to one of its own alphabet, case kept; what `fixed` names and all else stays."""
    spots = [(i, _alphabet(c)) for i, c in enumerate(text) if _alphabet(c) and not fixed(i)]
    rank, m = 0, 1
    for i, alphabet in spots:
        place = ord(text[i]) - HAN.start if alphabet is HAN else alphabet.index(text[i].lower())
        rank, m = rank * len(alphabet) + place, m * len(alphabet)
    # the permutation depends on the format: the alphabets by place and all that stays
    shape = list(text.lower()) if len(text.lower()) == len(text) else list(text)
    for i, alphabet in spots:
        shape[i] = "\uffff" if alphabet is HAN else alphabet[0]
    rank = Permutation(m, key, f"{tweak}\0{''.join(shape)}")(rank)
    out = list(text)
    for i, alphabet in reversed(spots):
        rank, k = divmod(rank, len(alphabet))
        c = chr(HAN[k]) if alphabet is HAN else alphabet[k]
        out[i] = c.upper() if text[i].isupper() else c
    return "".join(out)


def _luhn(digits: str) -> str:
    total = sum(d if i % 2 else (2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _number(text: str, key: str, tweak: str, keep: int, same: Callable = lambda d: True) -> str:
    d = _digits(text)
    p = Permutation(10 ** (len(d) - keep), key, f"{tweak}\0{d[:keep]}")
    step = lambda x: x[:keep] + str(p(int(x[keep:]))).zfill(len(x) - keep)
    return _refill(text, _until(step, d, same))


def _ip(text: str, key: str) -> str:
    p = Permutation(2**32, key, "ip")
    split = lambda n: [n >> s & 255 for s in (24, 16, 8, 0)]
    public = lambda n: 1 <= n >> 24 <= 223 and n >> 24 not in (10, 127)
    return ".".join(map(str, split(_until(p, int.from_bytes(bytes(map(int, text.split("."))), "big"), public))))


def _card(text: str, key: str) -> str:
    d = _digits(text)
    if _luhn(d[:-1]) != d[-1]:
        return _number(text, key, "account", 1, lambda x: _luhn(x[:-1]) != x[-1])
    body = _digits(_number(d[:-1], key, "card", 1))
    return _refill(text, body + _luhn(body))


def _email(text: str, key: str) -> str:
    at = text.index("@")
    labels = text[at + 1 :].split(".")
    kept = 2 if len(labels) > 2 and labels[-2].lower() == "example" else 1
    tail = len(text) - len(".".join(labels[-kept:]))
    return permute_letters(text, key, "email", lambda i: i >= tail)


def _country(digits: str) -> int:
    """Digits of the country code that an international number starts with."""
    return 1 if digits[:1] in COUNTRY_1 else 2 if digits[:2] in COUNTRY_2 else 3


def _phone(text: str, key: str) -> str:
    """By country and national digits alone; ten digits without a country are of country 1."""
    d = _digits(text)
    code = _country(d) if text.startswith("+") else 0
    own, country = d[code:], d[:code] or ("1" if len(d) == 10 else "")
    p = Permutation(10 ** len(own), key, f"phone\0{country}")
    step = lambda x: str(p(int(x))).zfill(len(x))
    return _refill(text, d[:code] + (_until(step, own, lambda x: x[:1] > "1") if own else ""))


def _name(word: str, key: str) -> str:
    """One word of a name."""
    if word in _KNOWN:
        names = GIVEN[_KNOWN[word]]
        return names[Permutation(len(names), key, f"given\0{_KNOWN[word]}")(names.index(word))]
    last = len(word) - 1 if ord(word[-1]) not in HAN else len(word)
    return _until(lambda x: permute_letters(x, key, "name", lambda i: i == last), word, lambda x: x in _KNOWN)


@functools.lru_cache(maxsize=100_000)
def surrogate(kind: str, original: str, key: str) -> str:
    if kind == "email":
        return _email(original, key)
    if kind == "ip":
        return _ip(original, key)
    if kind == "card":
        return _card(original, key)
    if kind == "phone":
        return _phone(original, key)
    if kind == "ssn":
        return _number(original, key, "ssn", 0)
    if kind.startswith("name"):
        return " ".join(_name(w, key) for w in original.split(" "))
    return permute_letters(original, key, kind, lambda i: i < 4 and kind in ("iban", "secret") and original[:4].isupper())


class _Free:
    """Places of a text that no span has taken."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.spans: list[tuple[int, int, str]] = []

    def take(self, span: tuple[int, int, str]) -> None:
        k = bisect.bisect_left(self.starts, span[0])
        if (k == 0 or self.spans[k - 1][1] <= span[0]) and (k == len(self.spans) or span[1] <= self.spans[k][0]):
            self.starts.insert(k, span[0])
            self.spans.insert(k, span)


def _local(text: str, at: int) -> int:
    """Where the local part of an address begins that ends before `at`; `at` if there is none."""
    start = at
    while start and text[start - 1] in _LOCAL:
        start -= 1
    whole = text[start:at]
    if whole.endswith("."):
        return at
    start += whole.rfind("..") + 2 if ".." in whole else 0
    return start + (text[start] == "." if start < at else 0)


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in order, without overlaps; earlier kinds below win."""
    found: list[tuple[int, int, str]] = []
    for m in _EMAIL.finditer(text) if "@" in text else ():
        start = _local(text, m.start())
        if start < m.start():
            found.append((start, m.end(), "email"))
    found += [(m.start("v"), m.end("v"), "secret") if m["v"] else (*m.span(), "secret") for m in _SECRET.finditer(text)]
    found += [(*m.span(), "iban") for m in _IBAN.finditer(text)]
    found += [(*m.span(), next(k for k in ("ip", "phone", "ssn", "card") if m[k])) for m in _NUMBERS.finditer(text)]
    names = [(*m.span(1), f"name_{gender}") for gender, pattern in _NAME.items() for m in pattern.finditer(text)]
    words = {w for s, e, _ in names for w in text[s:e].split(" ") if len(w) > 2 or ord(w[0]) in HAN}
    if words:
        again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(words, key=lambda w: (-len(w), w)))) + r")(?!\w)")
        names += [(*m.span(), "name_n") for m in again.finditer(text)]
    free = _Free()
    for span in [*found, *names]:
        free.take(span)
    return free.spans


def replace(text: str, key: str) -> tuple[str, list[tuple[int, int, str, str]]]:
    """The text with surrogates, and (start, end, kind, surrogate) by place in the original.

    Should two originals of the text meet in one surrogate, the later one walks on along its permutation until it is alone.
    """
    spans, owner = [], {}
    for s, e, kind in find(text):
        new, own = surrogate(kind, text[s:e], key), _form(kind, text[s:e])
        while owner.setdefault((kind[:4], _form(kind, new)), own) != own:
            new = surrogate(kind, new, key)
        spans.append((s, e, kind, new))
    out, at = [], 0
    for s, e, _, new in spans:
        out += [text[at:s], new]
        at = e
    return "".join([*out, text[at:]]) if spans else text, spans


def _form(kind: str, text: str) -> str:
    """The one form of an entity's spellings."""
    if kind == "phone":
        d = _digits(text)
        return d if text.startswith("+") or len(d) != 10 else "1" + d
    return _digits(text) if kind in ("card", "ssn") else text.lower()


ENTITIES = "array<struct<start:int,end:int,kind:string,surrogate:string>>"


def query_key(spark: SparkSession) -> str:
    """The key of the session's configuration, or a random one that this application keeps."""
    app = spark.sparkContext.applicationId
    return spark.conf.get(KEY_CONF, None) or _session_keys.setdefault(app, secrets.token_hex(32))


_session_keys: dict[str, str] = {}


def pseudonymize(documents: DataFrame, key: str) -> DataFrame:
    """Replaces `text`; adds entities, spans in code points of the original text. All other columns stay."""
    if not key:
        raise ValueError("surrogates need a key")
    added = "entities"
    while added in documents.columns:
        added += "_"
    at = documents.columns.index("text")
    schema = T.StructType([*documents.schema.fields, T.StructField(added, T._parse_datatype_string(ENTITIES))])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("surrogate", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("pii", surrogate.cache_clear)
        for b in batches:
            texts, spans = [], []
            for t in b.column(at):
                t = t.as_py()
                new, found = (None, []) if t is None else replace(t, key)
                texts.append(new)
                spans.append([dict(zip(("start", "end", "kind", "surrogate"), x, strict=True)) for x in found])
            columns = [*b.columns[:at], pa.array(texts, b.schema.field(at).type), *b.columns[at + 1 :], pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, added])

    return documents.mapInArrow(run, schema)


def collisions(originals: DataFrame, replaced: DataFrame) -> DataFrame:
    """(kind, surrogate) of two or more originals anywhere in the corpus; both tables have a unique doc_id. Empty when all is well."""
    pairs = originals.select("doc_id", F.col("text").alias("old")).join(replaced.select("doc_id", F.explode("entities").alias("e")), "doc_id")
    pairs = pairs.select("e.kind", "e.surrogate", F.substring("old", F.col("e.start") + 1, F.col("e.end") - F.col("e.start")).alias("original"))
    return pairs.groupBy("kind", "surrogate").agg(F.countDistinct("original").alias("n")).where("n > 1")
