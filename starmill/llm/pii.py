"""Personal data and secrets replaced by keyed, type-consistent surrogates.

Kinds: EMAIL, PHONE, IPV4, IPV6, CARD, SSN, IBAN, SECRET, PERSON (a name after a form
of address, or after a known first name). Entities are reduced to a canonical form
(letter case, separators and trunk prefix aside), and the surrogate is a function of
key, kind and canonical form; it is then written in the format of the mention. So
mentions of one entity get one surrogate in every document and form, in any run with
the key, whatever else is in the corpus.

Distinct entities stay distinct, as every kind goes through a keyed permutation of all
values of its format (a Feistel network with cycle walking), which can't collide: a
card keeps the state of its check digit, an IBAN its country and the state of its check
sum, a phone number its country code, an address its class (private, loopback,
multicast, public) or its first group. Words of names are numbers, too: shorter
words first, then by letters; their permutation is written in syllables of the
mention's script, as many as hold the words of that length, with an ending that tells the
gender of the form of address, or of a known first name. A name's words are replaced
one by one, so that "Mr. Smith" after "John Smith" agrees. After the pass a job over
all entities looks for two with one surrogate, which is an error. With ``syllables``
given, names are short draws instead; those that collide draw again, in rounds.

Defined results: null texts stay null, empty ones empty, each without entities; very
long texts are searched whole; overlapping finds go to the earlier, then the longer;
repeated rows get the same text; an empty table stays empty; all other columns pass
through unchanged, whatever their names.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.common import drop_scratch, spill, table

KEY = b"surrogate-key-1"
EXCEPTIONS = 100_000
ROUNDS = 20
"""Rounds of short draws after which they get a syllable more."""

#: forms of address and the gender they tell
ADDRESS = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Mme": "f", "Mlle": "f", "Monsieur": "m", "Madame": "f", "Señor": "m", "Señora": "f", "Sra": "f", "Dr": "", "Prof": "", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
#: first names that tell a gender where the form of address doesn't
FIRST = {"f": "Alice Anna Barbara Carmen Claire Elena Emma Eva Julia Laura Linda Lucia Maria Marie Mary Patricia Sarah Sophie Susan Анна Елена Мария Ольга Ελένη Μαρία", "m": "Antonio Carlos David Hans Jean John José Karl Luis Michael Paul Peter Pierre Robert Thomas William Александр Иван Сергей Γιώργος Νίκος"}
_GENDER = {n: g for g, names in FIRST.items() for n in names.split()}
#: country codes of one and two digits; all others have three (fixed values)
_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
#: onsets, vowels and endings by script
_SCRIPT = {
    "latin": ("b d f g h k l m n p r s t v".split(), "a e i o u".split(), {"f": ["a", "ia", "ine", "elle"], "m": ["o", "n", "rd", "us"], "": ["s", "r", "ck", "ley"]}),
    "cyrillic": ("б в г д ж з к л м н п р с т".split(), "а е и о у".split(), {"f": ["а", "ия", "ина", "ова"], "m": ["н", "р", "ов", "ил"], "": ["ко", "к", "ич", "ер"]}),
    "greek": ("β γ δ κ λ μ ν π ρ σ τ φ".split(), "α ε ι ο".split(), {"f": ["α", "η", "ια", "ω"], "m": ["ος", "ης", "ας", "ων"], "": ["ου", "ακη", "ιδη", "λου"]}),
}

_NUMBERS = re.compile(
    r"""(?P<IBAN>\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
    |(?P<IPV4>(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?!\.?[0-9]))
    |(?P<IPV6>(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?|::(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{1,4})(?![0-9A-Za-z:]))
    |(?P<SSN>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))
    |(?P<PHONE>(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\)[ ]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|0[0-9]{2,4}[ /-][0-9]{5,8})(?![0-9]))
    |(?P<CARD>(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z]))
    |(?P<SECRET>\b(?:[0-9a-f]{32,}|[0-9A-F]{32,})\b|\bAKIA[0-9A-Z]{16}\b|\b(?:sk|pk|rk)[-_][A-Za-z0-9_-]{20,}|\bgh[pousr]_[A-Za-z0-9]{30,})""",
    re.X,
)
_CALLED = re.compile(r"(?i:\b(?:phone|tel|call|mobile|cell|fax|telefon|mobil)\b\.?:? *)([0-9]{9,12})(?![0-9A-Za-z])")
_EMAIL = re.compile(r"[\w.%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAMED = re.compile(r"(?i:\b(?:token|secret|passwd|password|api[_-]?key|access[_-]?key)\b[\"']?\s*[:=]\s*[\"']?)([^\s\"'<>]{6,})")
_PERSON = re.compile(r"\b(" + "|".join(ADDRESS) + r")\b\.? ((?:[^\W\d_a-zа-яα-ω][\w'’-]+)(?: [^\W\d_a-zа-яα-ω][\w'’-]+){0,2})")
_FIRST = re.compile(r"\b(" + "|".join(n for names in FIRST.values() for n in names.split()) + r") ((?:[^\W\d_a-zа-яα-ω][\w'’-]+)(?: [^\W\d_a-zа-яα-ω][\w'’-]+)?)")
_MAYBE = r"[0-9@]|::|(?i:token|secret|passw|api[_-]?key|access[_-]?key)|[a-f]{32}|[A-F]{32}|AKIA|[spr]k[-_]|gh[pousr]_|" + "|".join([*ADDRESS, *_GENDER])
"""True of every text in which ``detect`` finds anything: without \\b, which is ASCII only in Arrow's expressions."""


# -- keyed values


def _draw(key: bytes, *parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), key=key, digest_size=8).digest(), "big")


def permute(key: bytes, tweak: str, x: int, size: int) -> int:
    """A keyed permutation of 0..size-1, by a Feistel network that is walked until it falls inside."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = x >> half, x & mask
        for i in range(6):
            a, b = b, a ^ (_draw(key, tweak, size, i, b) & mask)
        x = a << half | b
        if x < size:
            return x


def _digits(key: bytes, kind: str, digits: str) -> str:
    return str(permute(key, kind, int(digits), 10 ** len(digits))).zfill(len(digits)) if digits else ""


def _luhn(digits: str) -> int:
    """The sum that a valid card number makes a multiple of ten."""
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))


def _class(ip: int) -> str:
    a, b = ip >> 24, ip >> 16 & 255
    return "private" if a == 10 or (a == 172 and 16 <= b < 32) or (a == 192 and b == 168) else "loop" if a == 127 else "high" if a >= 224 else "none" if a == 0 else "public"


def _ip(key: bytes, canon: str) -> str:
    x = 0
    for p in canon.split("."):
        x = x << 8 | int(p)
    told = _class(x)
    if told == "public":
        base, size = 0, 1 << 32
    else:  # its own block, so that the walk is short
        keep = 8 if told != "private" or x >> 24 == 10 else 12 if x >> 24 == 172 else 16
        size = 1 << (32 - keep)
        base = x & ~(size - 1)
    y = x - base
    while True:
        y = permute(key, f"ip{base}", y, size)
        if _class(base + y) == told:
            return ".".join(str(base + y >> s & 255) for s in (24, 16, 8, 0))


_HEX = re.compile("[0-9a-f]{32,}|[0-9A-F]{32,}")


def _mixed(key: bytes, tweak: str, canon: str) -> str:
    """Letters to letters and digits to digits, all values of the pattern permuted; hexadecimal stays so; other ASCII signs stay."""
    if _HEX.fullmatch(canon):
        n = len(canon)
        out = f"{permute_wide(key, tweak + 'hex', int(canon, 16), 16**n):0{n}x}"
        return out.upper() if canon.isupper() else out
    # letters beyond ASCII have no order to permute in: drawn, and left to the check of collisions
    canon = "".join(chr(97 + _draw(key, tweak, canon, i) % 26) if c > "\x7f" and c.isalnum() else c for i, c in enumerate(canon))
    x, size = 0, 1
    kinds = [next((k for k in ("09", "az", "AZ") if k[0] <= c <= k[1]), "") for c in canon]
    for c, k in zip(canon, kinds, strict=True):
        if k:
            n = 10 if k == "09" else 26
            x, size = x * n + ord(c) - ord(k[0]), size * n
    if size == 1:
        return canon
    y = permute_wide(key, tweak + "".join(k[:1] for k in kinds), x, size)
    out = []
    for c, k in zip(reversed(canon), reversed(kinds), strict=True):
        if k:
            y, d = divmod(y, 10 if k == "09" else 26)
            out.append(chr(d + ord(k[0])))
        else:
            out.append(c)
    return "".join(reversed(out))


def permute_wide(key: bytes, tweak: str, x: int, size: int) -> int:
    """As ``permute``, for sizes beyond 128 bits too."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask, n = (1 << half) - 1, half // 8 + 1
    while True:
        a, b = x >> half, x & mask
        for i in range(6):
            f = hashlib.shake_256(key + f"\x1f{tweak}\x1f{size}\x1f{i}\x1f{b}".encode()).digest(n)
            a, b = b, a ^ (int.from_bytes(f, "big") & mask)
        x = a << half | b
        if x < size:
            return x


def _script(word: str) -> str:
    c = next((c for c in word if c.isalpha()), "a")
    return "cyrillic" if "\u0400" <= c <= "\u04ff" else "greek" if "\u0370" <= c <= "\u03ff" else "latin"


def name_word(ident: int, attempt: int, gender: str, script: str, syllables: int) -> str:
    onsets, vowels, ends = _SCRIPT[script]
    x = _draw(b"names", ident, attempt)
    out = []
    for _ in range(syllables):
        x, o = divmod(x, len(onsets))
        x, v = divmod(x, len(vowels))
        out.append(onsets[o] + vowels[v])
    return ("".join(out) + ends[gender][x % len(ends[gender])]).capitalize()


#: consonants that may close a syllable, by script; none first
_CODA = {"latin": ["", "n", "r", "s", "l", "m"], "cyrillic": ["", "н", "р", "с", "л", "м"], "greek": ["", "ν", "ρ", "σ", "λ", "μ"]}
#: plain letters by script; a word of others is a number in a wider base, and has another ending
_PLAIN = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρσςτυφχψω"}
#: endings of words of plain letters and of others, by script and gender; no ending is another's end
_END = {
    "latin": {"f": ("ia", "elle"), "m": ("us", "ard"), "": ("er", "ack")},
    "cyrillic": {"f": ("ия", "ова"), "m": ("ил", "ев"), "": ("ко", "ич")},
    "greek": {"f": ("ια", "ω"), "m": ("ος", "ης"), "": ("ου", "ακη")},
}


@lru_cache(1 << 16)
def permuted_word(key: bytes, word: str, gender: str, script: str) -> str:
    """A word's surrogate: one to one over all words of the script (lower case), by gender."""
    onsets, vowels, _ = _SCRIPT[script]
    size = len(onsets) * len(vowels) * len(_CODA[script])
    letters = _PLAIN[script]
    plain = all(c in letters for c in word)
    # shorter words first, then by letters: each word is one number
    x, base = 0, len(letters) if plain else 0x110000
    for c in word:
        x = x * base + 1 + (letters.index(c) if plain else ord(c))
    k = 2
    while x >= size**k:  # as many syllables as hold it; the words before those are numbered by fewer
        x -= size**k
        k += 1
    y, out = permute_wide(key, f"name\x1f{script}\x1f{gender}\x1f{plain}\x1f{k}", x, size**k), []
    for _ in range(k):
        y, d = divmod(y, size)
        d, o = divmod(d, len(onsets))
        c, v = divmod(d, len(vowels))
        out.append(onsets[o] + vowels[v] + _CODA[script][c])
    return "".join(out) + _END[script][gender][not plain]


def _iban_state(iban: str) -> int:
    """The rest by 97 that a valid IBAN leaves as 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(key: bytes, canon: str) -> str:
    """A valid number becomes a valid one of its country, any other another that isn't valid."""
    country, valid = canon[:2], _iban_state(canon) == 1
    if valid:
        body = _mixed(key, "iban" + country, canon[4:].lower()).upper()
        return f"{country}{98 - _iban_state(country + '00' + body):02d}{body}"
    rest = canon[2:]
    while True:  # ends, as the walk comes back to the number itself
        rest = _mixed(key, "iban-" + country, rest.lower()).upper()
        if _iban_state(country + rest) != 1:
            return country + rest


def _ipv6(key: bytes, canon: str) -> str:
    """All groups but the first, which tells the address's class, are permuted."""
    x = int(ipaddress.IPv6Address(canon))
    low = permute_wide(key, f"ip6{x >> 112}", x & ((1 << 112) - 1), 1 << 112)
    return ipaddress.IPv6Address(x >> 112 << 112 | low).exploded


def _phone(key: bytes, canon: str) -> str:
    """National digits, by country; a first digit that is no 0 stays so."""
    country, _, digits = canon.rpartition(":")
    out = digits
    while True:  # ends, as the walk comes back to the number itself
        out = _digits(key, f"PHONE{country}", out)
        if (out[:1] == "0") == (digits[:1] == "0"):
            return out


class Surrogates:
    """Surrogates of one key. ``syllables``: names are draws of so many; ``attempts``: the draws of those that collided."""

    def __init__(self, key: bytes = KEY, attempts: dict[int, int] | None = None, syllables: int | None = None):
        self.key, self.attempts, self.syllables = key, attempts or {}, syllables
        self.value = lru_cache(1 << 16)(self._value)

    def _value(self, kind: str, canon: str) -> str:
        key = self.key
        if kind == "IPV4":
            return _ip(key, canon)
        if kind == "CARD":
            body = _digits(key, f"card{_luhn(canon) % 10}", canon[:-1])
            want = _luhn(canon) % 10
            return body + str((want - _luhn(body + "0")) % 10)
        if kind == "SSN":
            return _digits(key, kind, canon)
        if kind == "PHONE":
            return _phone(key, canon)
        if kind == "IPV6":
            return _ipv6(key, canon)
        if kind == "IBAN":
            return _iban(key, canon)
        if kind == "EMAIL":
            local, _, host = canon.rpartition("@")
            # the host's last label stays: it tells the type of address
            name, _, top = host.rpartition(".")
            return f"{_mixed(key, 'mail' + top, local + '@' + name)}.{top}"
        return _mixed(key, kind, canon)

    def person(self, word: str, gender: str) -> tuple[int, str, str]:
        """(identity, canonical form of the replacement, replacement) of one word of a name."""
        script = _script(word)
        ident = _draw(self.key, "PERSON", gender, script, word.lower()) >> 1
        if self.syllables is None:
            out = permuted_word(self.key, word.lower(), gender, script).capitalize()
        else:
            out = name_word(ident, self.attempts.get(ident, 0), gender, script, self.syllables)
        return ident, out.lower(), out.upper() if word.isupper() and len(word) > 1 else out


def canonical(kind: str, found: str) -> str:
    if kind in ("CARD", "SSN"):
        return re.sub("[^0-9]", "", found)
    if kind == "PHONE":
        d = re.sub("[^0-9]", "", found)
        if found.startswith("+"):
            code = next((d[:n] for n in (1, 2) if d[:n] in _CODES), d[:3])
            return d[1:] if code == "1" and len(d) == 11 else f"{code}:{d[len(code):]}"
        return d[1:] if len(d) == 11 and d[0] == "1" else d
    if kind == "IPV6":
        return ipaddress.IPv6Address(found).exploded
    if kind == "IPV4":
        return ".".join(str(int(p)) for p in found.split("."))
    if kind == "IBAN":
        return found.replace(" ", "").upper()
    return found if kind == "SECRET" else found.lower()


def render(kind: str, found: str, value: str) -> str:
    """``value`` in the format of ``found``: its separators, prefix and letter case."""
    if kind in ("CARD", "SSN", "PHONE", "IBAN"):
        signs = [i for i, c in enumerate(found) if c.isdigit() or (kind == "IBAN" and c.isalnum())]
        out = list(found)
        for i, c in zip(reversed(signs), reversed(value), strict=False):
            out[i] = c
        return "".join(out)
    if kind == "IPV6":
        value = str(ipaddress.IPv6Address(value)) if "::" in found or len(found) < 39 else value
        return value.upper() if found.isupper() else value
    if kind == "EMAIL" and found.isupper():
        return value.upper()
    return value


def _address(found: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(found)) and any(c.isdigit() for c in found)
    except ValueError:
        return False


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, without overlaps."""
    found = [(m.start(), m.end(), "EMAIL") for m in _EMAIL.finditer(text)] if "@" in text else []
    numbers = [(m.start(), m.end(), m.lastgroup if m.lastgroup != "gap" else "CARD") for m in _NUMBERS.finditer(text)]
    found += [x for x in numbers if x[2] != "IPV6" or _address(text[x[0] : x[1]])]
    found += [(m.start(1), m.end(1), "PHONE") for m in _CALLED.finditer(text)]
    found += [(m.start(1), m.end(1), "SECRET") for m in _NAMED.finditer(text)]
    found += [(m.start(2), m.end(2), "PERSON:" + ADDRESS[m[1]]) for m in _PERSON.finditer(text)]
    found += [(m.start(), m.end(), "PERSON:" + _GENDER[m[1]]) for m in _FIRST.finditer(text)]
    out: list[tuple[int, int, str]] = []
    for s, e, kind in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or s >= out[-1][1]:
            out.append((s, e, kind))
    return out


def _names(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Names word by word, and later bare mentions of their last words."""
    out, last = [], {}
    for s, e, kind in found:
        if not kind.startswith("PERSON"):
            out.append((s, e, kind))
            continue
        parts = [(s + m.start(), s + m.end(), m[0]) for m in re.finditer(r"[^ ]+", text[s:e])]
        gender = kind[7:] or _GENDER.get(parts[0][2], "")
        for i, (a, b, w) in enumerate(parts):
            only = i == len(parts) - 1
            out.append((a, b, "PERSON:" + ("" if only else gender)))
            if only and len(w) > 2:
                last[w] = True
    if last:
        taken = sorted((s, e) for s, e, _ in out)
        for m in re.finditer(r"\b(?:" + "|".join(map(re.escape, last)) + r")\b", text):
            if not any(s < m.end() and m.start() < e for s, e in taken):
                out.append((m.start(), m.end(), "PERSON:"))
    return sorted(out)


def rewrite(text: str, by: Surrogates) -> tuple[str, list[tuple[str, int, str, int, int, str]]]:
    """The text with surrogates, and (kind, identity, canonical surrogate, start, end, surrogate) of each."""
    out, at, told = [], 0, []
    for s, e, kind in _names(text, detect(text)):
        was = text[s:e]
        if kind.startswith("PERSON"):
            ident, canon, new = by.person(was, kind[7:])
            kind = "PERSON"
        else:
            form = canonical(kind, was)
            canon = by.value(kind, form)
            ident, new = _draw(by.key, kind, form) >> 1, render(kind, was, canon)
        out += [text[at:s], new]
        at = e
        told.append((kind, ident, canon, s, e, new))
    return "".join([*out, text[at:]]), told


ENTITY = "array<struct<kind:string,ident:bigint,canon:string,start:int,end:int,surrogate:string>>"


def _task(key: bytes, attempts, syllables: int | None, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Surrogates(key, attempts.value if attempts else None, syllables)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("ident", pa.int64()), ("canon", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))
        for batch in batches:
            col = batch.column("text")
            hits = pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(col, _MAYBE), False)).to_pylist()
            new, told = {}, [[] for _ in range(len(batch))]
            for i, text in zip(hits, col.take(pa.array(hits, pa.int64())).to_pylist(), strict=True):
                done, found = rewrite(text, by)
                if found:
                    new[i] = done
                    told[i] = [dict(zip(("kind", "ident", "canon", "start", "end", "surrogate"), x, strict=True)) for x in found]
            if new:
                mask = [i in new for i in range(len(batch))]
                col = pc.replace_with_mask(col, pa.array(mask), pa.array([new[i] for i in sorted(new)], col.type))
            cols = [col if n == "text" else batch.column(i) for i, n in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(told, kind)], names=[*batch.schema.names, name])

    return run


def surrogate(docs: DataFrame, key: bytes = KEY, syllables: int | None = None) -> tuple[DataFrame, str]:
    """``docs`` with surrogates in text, written, and the name of the added column of entities."""
    name = "entities"
    while name in docs.columns:
        name += "_"
    entity = T._parse_datatype_string(ENTITY)
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in docs.schema], T.StructField(name, entity, True)])
    attempts, rounds = None, 0
    while True:
        out = spill(docs.mapInArrow(_task(key, attempts, syllables, name), schema), "surrogates")
        seen = out.select(F.explode(name).alias("x")).select("x.kind", "x.ident", "x.canon").distinct()
        shared = seen.groupBy("kind", "canon").agg(F.count("*").alias("n")).where("n > 1").groupBy("kind").count().collect()  # a row per kind
        if not shared:
            return out, name
        if syllables is None or any(r["kind"] != "PERSON" for r in shared):
            raise ValueError(f"surrogates collide: {shared}")
        again, rounds = _collided(seen, attempts.value if attempts else {}), rounds + 1
        few = again.limit(EXCEPTIONS + 1).collect()  # of a checked number
        drop_scratch(out)
        if len(few) > EXCEPTIONS or rounds % ROUNDS == 0:
            syllables, attempts = syllables + 1, None
        else:
            attempts = docs.sparkSession.sparkContext.broadcast({**(attempts.value if attempts else {}), **{r["ident"]: r["attempt"] for r in few}})


def _collided(seen: DataFrame, had: dict[int, int]) -> DataFrame:
    """(ident, attempt) of the names that must draw again: all but the least identity of each surrogate."""
    rank = F.row_number().over(Window.partitionBy("canon").orderBy("ident"))
    lost = seen.where("kind = 'PERSON'").withColumn("r", rank).where("r > 1")
    old = seen.sparkSession.createDataFrame(list(had.items()), "had long, tried int")
    return lost.join(old, F.col("ident") == F.col("had"), "left").select("ident", (F.coalesce("tried", F.lit(0)) + F.col("r") - 1).cast("int").alias("attempt"))


def clean_documents(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with surrogates, the same columns; n_chars follows the new text."""
    out, name = surrogate(docs, key)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(name) > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op4(spark, sf_dir: str) -> DataFrame:
    out, name = surrogate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform(name, lambda x: x["kind"]))), ",")
    spans = F.transform(name, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["surrogate"].alias("surrogate")))
    return out.select("doc_id", "text", F.size(name).cast("long").alias("n_entities"), kinds.alias("kinds"), spans.alias("entities"))
