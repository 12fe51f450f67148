"""Personal data replaced by keyed surrogates of the same type and form.

Every text is searched whole. Each distinct entity (type and canonical value) gets a surrogate
drawn from a keyed hash: letters for letters and digits for digits of the same script, valid
check digits, names of the same gender and script. Surrogates are checked for collisions over
the whole corpus, with each other and with the real values, and drawn again until there are
none, so that different entities stay different and one entity has one surrogate everywhere.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty
from turnlens.sources.tables import pin

# Forms of address by gender.
MALE = "Mr Mister Herr Herrn Señor Sr Monsieur Don господин г-н κύριος"
FEMALE = "Mrs Ms Miss Frau Señora Sra Señorita Madame Mme Mademoiselle Doña госпожа г-жа κυρία"

# Common given names by gender and script.
GIVEN = {
    "given_m_latin": "James John Robert Michael William David Thomas Daniel Peter Paul Hans Karl Jürgen Pierre Jean "
    "Louis Antoine José Carlos Juan Miguel Pedro",
    "given_f_latin": "Mary Patricia Jennifer Linda Elizabeth Susan Sarah Karen Emma Julia Ursula Heike Sabine Marie "
    "Claire Sophie Camille María Carmen Lucía Isabel Elena",
    "given_m_cyrillic": "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил Владимир Павел",
    "given_f_cyrillic": "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия",
    "given_m_greek": "Γιώργος Δημήτρης Νίκος Κώστας Παναγιώτης",
    "given_f_greek": "Μαρία Ελένη Κατερίνα Σοφία Άννα",
}
GIVEN = {kind: tuple(names.split()) for kind, names in GIVEN.items()}
KIND_OF_NAME = {name: kind for kind, names in GIVEN.items() for name in names}

# Syllables of made-up surnames, and endings by gender for made-up given names.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve".split(),
    "cyrillic": "ба бе бо да де до ва ве га го ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то".split(),
    "greek": "βα γα δα κα κο λα λο μα μο να νο πα πο ρα ρο σα σο τα το".split(),
}
ENDINGS = {"m": {"latin": "n", "cyrillic": "н", "greek": "ς"}, "f": {"latin": "ia", "cyrillic": "ия", "greek": "ία"}}

WORD = r"[A-ZÀ-ÖØ-ÞА-ЯЁΆ-Ϋ][a-zß-öø-ÿа-яёά-ώ]+"
TITLES = "|".join(sorted((re.escape(t) for t in f"{MALE} {FEMALE}".split()), key=len, reverse=True))
NAMES = "|".join(sorted(KIND_OF_NAME, key=len, reverse=True))

#: Patterns in the order in which they claim a place; group ``v`` is what is replaced.
PATTERNS = (
    ("email", re.compile(r"(?<![\w.+-])(?P<v>[\w.%+-]{1,64}@(?:[\w-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![\w-])")),
    ("secret", re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?(?P<v>[\w+/.-]{8,})")),
    ("aws_key", re.compile(r"\b(?P<v>A[KS]IA[0-9A-Z]{16})\b")),
    ("iban", re.compile(r"\b(?P<v>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")),
    ("ip", re.compile(r"(?<![\w.])(?P<v>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\w]|\.\d)")),
    ("card", re.compile(r"(?<![\w.-])(?P<v>\d(?:[ -]?\d){12,18})(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])(?P<v>\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.])(?P<v>(?:\+\d{1,3} ?)?\(\d{3}\) ?\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])")),
)
PERSON = re.compile(rf"(?<!\w)(?:(?P<title>{TITLES})\.? (?P<first>{WORD})(?: (?P<last>{WORD}))?|(?P<given>{NAMES}) (?P<family>{WORD}))(?!\w)")
#: A whole word that may be a name, also in a double name or before an apostrophe.
CAPITALISED = re.compile(rf"(?<!\w){WORD}(?!\w)")

SPANS = "array<struct<start:int,stop:int,kind:string,value:string>>"


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in f"{body}{country}00")
    return f"{98 - int(number) % 97:02d}"


def canonical(kind: str, found: str) -> str | None:
    """The value that tells entities of a kind apart, or None if it is not one."""
    if kind == "email":
        return found.lower()
    if kind == "iban":
        plain = found.replace(" ", "")
        return plain if 15 <= len(plain) <= 34 and iban_check(plain[:2], plain[4:]) == plain[2:4] else None
    if kind == "card":
        digits = re.sub(r"\D", "", found)
        return digits if luhn(digits) and len(set(digits)) > 1 else None
    if kind == "phone":
        digits = re.sub(r"\D", "", found)
        return ("+" if found[0] == "+" else "") + digits if 9 <= len(digits) <= 15 else None
    return found


def script_of(name: str) -> str:
    return "greek" if "Ͱ" <= name[0] <= "Ͽ" else "cyrillic" if "Ѐ" <= name[0] <= "ӿ" else "latin"


def people(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Given names and surnames apart, so that both Mr Smith and John Smith keep one surname."""
    for m in PERSON.finditer(text):
        if m["given"]:
            yield (*m.span("given"), KIND_OF_NAME[m["given"]], m["given"])
            yield (*m.span("family"), f"surname_{script_of(m['family'])}", m["family"])
            continue
        if m["last"]:
            kind = KIND_OF_NAME.get(m["first"], f"given_{'m' if m['title'] in MALE.split() else 'f'}_{script_of(m['first'])}")
            yield (*m.span("first"), kind, m["first"])
        surname = "last" if m["last"] else "first"
        yield (*m.span(surname), f"surname_{script_of(m[surname])}", m[surname])


def mentions(text: str, named: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """Every other place of the names found in a text, as whole words; a name of two kinds is of the first found."""
    kinds: dict[str, str] = {}
    for _, _, kind, name in named:
        kinds.setdefault(name, kind)
    if kinds:
        for m in CAPITALISED.finditer(text):
            if m[0] in kinds:
                yield (*m.span(), kinds[m[0]], m[0])


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, stop, kind, canonical value) without overlaps, in text order."""
    taken: list[tuple[int, int, str, str]] = []
    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text):
            value = canonical(kind, m["v"])
            if value is not None:
                taken.append((*m.span("v"), kind, value))
    named = list(people(text))
    taken.extend(named)
    taken.extend(mentions(text, named))
    free: list[tuple[int, int, str, str]] = []
    starts: list[int] = []
    for item in taken:  # earlier patterns go first
        at = bisect(starts, item[0])
        if (at == 0 or free[at - 1][1] <= item[0]) and (at == len(free) or item[1] <= free[at][0]):
            starts.insert(at, item[0])
            free.insert(at, item)
    return free


class Draw:
    """Numbers from a keyed hash; the same for the same key, kind, value and attempt."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.count, self.pool = key, "\x1f".join(parts).encode(), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            block = hmac.new(self.key, self.seed + self.count.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.count = (self.pool << 256) | int.from_bytes(block, "big"), self.count + 1
        self.pool, value = divmod(self.pool, n)
        return value

    def of(self, choices):
        return choices[self.below(len(choices))]


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def same_form(value: str, draw: Draw) -> str:
    """Letters for letters, digits for digits; hexadecimal stays hexadecimal, marks stay."""
    is_hex = re.fullmatch(r"[0-9a-f]+", value) is not None
    out = []
    for c in value:
        if is_hex:
            out.append(draw.of(DIGITS if c.isdigit() else "abcdef"))
        elif c.isdigit():
            out.append(draw.of(DIGITS))
        elif c.isalpha():
            out.append(draw.of(UPPER if c.isupper() else LOWER))
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """A value of the same kind and form; from the 32nd attempt on one character longer each."""
    draw = Draw(key, kind, value, str(attempt))
    more = max(0, attempt - 31)
    if kind == "email":
        local, domain = value.split("@")
        labels = domain.split(".")
        return f"{same_form(local + 'a' * more, draw)}@{'.'.join(same_form(x, draw) for x in labels[:-1])}.{labels[-1]}"
    if kind == "aws_key":
        return value[:4] + "".join(draw.of(UPPER + "234567") for _ in value[4:])
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        body = value[0] + "".join(draw.of(DIGITS) for _ in value[1:-1])
        return next(body + d for d in DIGITS if luhn(body + d))
    if kind == "iban":
        body = same_form(value[4:], draw)
        return value[:2] + iban_check(value[:2], body) + body
    if kind == "phone":
        keep = 1 + max(1, len(value) - 11) if value[0] == "+" else 0
        return value[:keep] + draw.of(DIGITS[2:]) + "".join(draw.of(DIGITS) for _ in value[keep + 1 :])
    if kind.startswith("surname_"):
        parts = [draw.of(SYLLABLES[kind[8:]]) for _ in range(3 + attempt // 8)]
        return "".join(parts).capitalize()
    if kind.startswith("given_"):
        _, gender, script = kind.split("_")
        if attempt < 8:
            return draw.of(GIVEN[kind])
        parts = [draw.of(SYLLABLES[script]) for _ in range(1 + attempt // 8)]
        return "".join(parts).capitalize() + ENDINGS[gender][script]
    return same_form(value + "a" * more, draw)


def written(kind: str, found: str, new: str) -> str:
    """The surrogate in the way the entity was written: its separators and its letter case."""
    if kind in ("card", "phone", "iban"):
        plain = iter(new.lstrip("+") if kind == "phone" else new)
        return "".join(next(plain) if c.isalnum() else c for c in found)
    if kind == "email" and len(new) == len(found):
        return "".join(n.upper() if c.isupper() else n for c, n in zip(found, new))
    return new


@dataclass(frozen=True)
class Surrogates:
    key: str = "turnlens"


def find_entities():
    @F.pandas_udf(SPANS)
    def find(texts: pd.Series) -> pd.Series:
        names = ("start", "stop", "kind", "value")
        return texts.map(lambda t: [dict(zip(names, e)) for e in entities(t)])

    return find


def assign(values: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate: one surrogate per entity, none used twice, none a real value."""

    @F.pandas_udf("string")
    def draw(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        secret = key.encode()
        return pd.Series([surrogate(k, v, int(a), secret) for k, v, a in zip(kind, value, attempt)])

    real = pin(values.select("kind", "value").distinct(), "entities")
    drawn = draw("kind", "value", "attempt").alias("surrogate")
    tried = real.withColumn("attempt", F.lit(0)).select("*", drawn, F.lit(False).alias("settled"))
    taken = real.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        tried = pin(tried, "surrogates")
        # Settled surrogates keep their owner; else the smallest value does.
        owners = tried.groupBy("kind", "surrogate").agg(F.min(F.struct(~F.col("settled"), "value")).alias("owner"))
        judged = tried.join(owners, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        settled = (F.col("owner.value") == F.col("value")) & F.col("real").isNull()
        judged = pin(judged.select("kind", "value", "attempt", "surrogate", settled.alias("settled")), "surrogates")
        again = judged.filter(~F.col("settled"))
        if again.isEmpty():
            return judged.select("kind", "value", "surrogate")
        redrawn = again.select("kind", "value", (F.col("attempt") + 1).alias("attempt")).select("*", drawn, F.lit(False).alias("settled"))
        tried = judged.filter("settled").unionByName(redrawn)


def replace_entities(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", surrogates: Surrogates = Surrogates()
) -> DataFrame:
    """``docs`` with personal data in the text replaced, pii_count and pii_kinds (sorted, comma-joined).

    Texts without an entity, null and empty ones among them, stay as they are. Texts of any
    length are searched whole. Repeated rows are replaced alike. An empty table gives an empty
    result. Other columns are returned as they are; columns of ``docs`` named pii_count or
    pii_kinds are replaced. The same key gives the same surrogates for the same corpus.
    """
    columns = [c for c in docs.columns if c not in ("pii_count", "pii_kinds")]
    identity = F.col(f"`{id_col}`").cast("string"), text_or_empty(text_col)
    keys = [F.xxhash64(*identity, F.lit(1)).alias("k1_"), F.xxhash64(*identity, F.lit(2)).alias("k2_")]
    plain = docs.select(*keys, text_or_empty(text_col).alias("text"))
    found = pin(plain.select("k1_", "k2_", find_entities()("text").alias("spans")).filter(F.size("spans") > 0), "spans")
    spans = found.distinct().select("k1_", "k2_", F.explode("spans").alias("s")).select("k1_", "k2_", "s.*")
    mapped = spans.join(assign(spans, surrogates.key), ["kind", "value"])
    edits = mapped.groupBy("k1_", "k2_").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind", "surrogate"))).alias("edits_"))

    @F.pandas_udf("string")
    def edited(texts: pd.Series, edits: pd.Series) -> pd.Series:
        def one(text: str, own) -> str:
            parts, at = [], 0
            for e in own:
                parts += [text[at : e["start"]], written(e["kind"], text[e["start"] : e["stop"]], e["surrogate"])]
                at = e["stop"]
            return "".join(parts) + text[at:]

        return pd.Series([t if own is None or not len(own) else one(t, own) for t, own in zip(texts, edits)])

    joined = docs.select(*[F.col(f"`{c}`") for c in columns], *keys).join(edits, ["k1_", "k2_"], "left")
    text = F.when(F.col("edits_").isNull(), F.col(f"`{text_col}`").cast("string")).otherwise(edited(text_or_empty(text_col), "edits_"))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("edits_", lambda e: e["kind"]))), ",")
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns],
        F.when(F.col("edits_").isNull(), 0).otherwise(F.size("edits_")).alias("pii_count"),
        F.coalesce(kinds, F.lit("")).alias("pii_kinds"),
    )
