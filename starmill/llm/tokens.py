"""Byte-level BPE ids of whole texts.

The tokenizer is a file of the ``tokenizers`` library. That library encodes about
1.3 MB/s on a core, too slow for the whole corpus; the same vocabulary, read from
the same file, goes through ``tiktoken`` at about 7 MB/s with the same ids. The
library stays the authority: a file that isn't plain byte-level BPE is refused, every
``SPOT``-th text of a task is encoded whole by both, whatever its length, and a
difference ends the job. ``engine="tokenizers"`` uses the library alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
END = 0
SPOT = 500
#: the pre-token pattern of byte-level BPE vocabularies, fixed by the format
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_made: dict[tuple, Callable[[str], list[int]]] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _bytes_of() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others for 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def specification(path: str | None = None) -> dict:
    """The tokenizer's file; refused if its ids don't follow from the vocabulary's ranks under ``PATTERN``."""
    with open(path or vocabulary_path(), encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", ())]
    faults = [
        name
        for name, bad in (
            ("model", model.get("type", "BPE") != "BPE"),
            ("normalizer", spec.get("normalizer") is not None),
            ("pre_tokenizer", before.get("type") != "ByteLevel" or before.get("add_prefix_space") or before.get("use_regex") is False),
            ("order of merges", merged != sorted(merged)),
            ("dropout or prefixes", bool(model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"))),
        )
        if bad
    ]
    if faults:
        raise ValueError(f"not a plain byte-level BPE file: {', '.join(faults)}")
    return spec


def id_width(path: str | None = None) -> int:
    """Bytes that hold every id of the vocabulary: 2 or 4."""
    spec = specification(path)
    most = max([END, *spec["model"]["vocab"].values(), *[t["id"] for t in spec.get("added_tokens", ())]])
    return 2 if most < 1 << 16 else 4


def encoder(path: str | None = None, engine: str = "tiktoken") -> Callable[[str], list[int]]:
    """text -> ids, without added tokens; made once in a worker. ``path``: the tokenizer file, at the same place on all machines; None: the public one."""
    path = path or vocabulary_path()
    key = (path, engine)
    if key in _made:
        return _made[key]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)

    def slow(text: str) -> list[int]:
        return library.encode(text, add_special_tokens=False).ids

    if engine == "tokenizers":
        _made[key] = slow
        return slow
    import tiktoken

    spec = specification(path)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    back = _bytes_of()
    ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    count = 0

    def encode(text: str) -> list[int]:
        nonlocal count
        ids = fast.encode(text, allowed_special="all") if any(s in text for s in special) else fast.encode_ordinary(text)
        if count % SPOT == 0 and ids != slow(text):
            raise ValueError("the two encoders disagree on a text")
        count += 1
        return ids

    _made[key] = encode
    return encode


def with_end(ids: list[int]) -> np.ndarray:
    """The ids and the end id, as little-endian 32-bit integers."""
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1] = ids
    out[-1] = END
    return out
