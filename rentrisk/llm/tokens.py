"""Token ids of texts by a public tokenizer file, through the ``tokenizers`` library.

The library cuts a text by a pattern, and merges bytes within each part only. The pattern always cuts between a
character that is no white space and a space after it, so a batch of texts is split at its spaces by Arrow, and each different
word's ids are looked up once a batch. A word that the worker has not met yet is cut by the pattern, and its parts are looked up or go to the
library's model. Texts where a space follows white space are cut by the pattern as a whole. A worker keeps the ids of about
``CACHE`` words. The ids are those of the library for the whole text: a text that holds the string of a special token
goes to the library as it is, which gives that token's id.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

FILE = "byte_bpe_50k.json"
END = 2
CACHE = 800_000
STOPS = frozenset(".,;:!?")


def _path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it can be shown, else 256 and up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Known(dict):
    """Ids of words in bytes, made when first asked for; ``before`` is what stands in front of each word in the text."""

    def __init__(self, encoder: Encoder, before: str):
        self.encoder, self.before = encoder, before

    def __missing__(self, word: str) -> bytes:
        # the pattern always cuts between a letter and a stop; words with their stops would fill the cache
        if word[-1:] in STOPS and "A" <= word[-2:-1] < "\u0250" and word[-2].isalpha():
            return self[word[:-1]] + self.encoder.plain[word[-1]]
        if word.isalpha():
            # the pattern never cuts between letters
            ids = self[word] = self.encoder.part(self.before + word)
            return ids
        parts = self.encoder.cut(self.before + word)
        if len(parts) != 1:
            return b"".join(map(self.encoder.look_up, parts))
        ids = self[word] = self.encoder.part(parts[0])
        return ids


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, in bytes."""

    _made: dict[str, Encoder] = {}

    def __init__(self, name: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(_path(name))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = byte_letters()
        self.space = self.letters[32]
        self.plain, self.spaced = Known(self, ""), Known(self, " ")

    @classmethod
    def of(cls, name: str = FILE) -> Encoder:
        """The worker's encoder: made once, used by all tasks that the worker runs."""
        if name not in cls._made:
            cls._made[name] = cls(name)
        return cls._made[name]

    def part(self, part: str) -> bytes:
        """Ids of a part that the pattern does not cut."""
        if part.isascii() and part.isprintable():
            shown = part.replace(" ", self.space)
        else:
            shown = part.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack("<%dI" % len(ids), *ids)

    def look_up(self, part: str) -> bytes:
        return self.spaced[part[1:]] if part[0] == " " and len(part) > 1 else self.plain[part]

    def forget(self) -> None:
        """Start afresh when the cache is full."""
        if len(self.plain) + len(self.spaced) > CACHE:
            self.plain.clear()
            self.spaced.clear()

    def encode(self, text: str) -> bytes:
        """Ids of any text, part by part."""
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.look_up, self.cut(text)))


#: Words whose ids are laid out at a time.
RUN = 1 << 18
#: White space of any kind before a space, as Arrow's pattern library writes it.
_BLANK_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "


def _plain_texts(texts: pa.Array, encoder: Encoder) -> Iterator[bytes]:
    """Ids of texts without a space after white space and without special tokens.

    They are split at their spaces, the words numbered by value, each different word looked up once, and the ids of
    all words laid out by number.
    """
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    first = np.concatenate([[0], ends[:-1]])
    # a text's first word has no space before it
    later = np.ones(len(words), bool)
    later[first] = False
    coded = words.filter(pa.array(later)).dictionary_encode()
    known = [encoder.spaced[w] for w in coded.dictionary.to_pylist()]
    index = np.empty(len(words), np.int64)
    index[later] = coded.indices.to_numpy(zero_copy_only=False)
    index[first] = np.arange(len(known), len(known) + len(first))
    known += [encoder.plain[w] for w in words.take(pa.array(first)).to_pylist()]
    ids = np.frombuffer(b"".join(known), "<u4")
    length = np.fromiter(map(len, known), np.int64, len(known)) // 4
    start = np.cumsum(length) - length
    done = []
    for f in range(0, len(index), RUN):
        at = index[f:f + RUN]
        n = length[at]
        to = np.cumsum(n)
        done.append(ids[np.repeat(start[at] - (to - n), n) + np.arange(to[-1])])
    out = np.concatenate(done)
    total = np.cumsum(length[index])
    lo = 0
    for e in ends:
        hi = int(total[e - 1])
        yield out[lo:hi].tobytes()
        lo = hi


def encode_batches(texts: pa.Array | list[str | None], name: str = FILE, end: int | None = END) -> Iterator[bytes]:
    """Yield the ids of each text, null as empty, ``end`` appended."""
    tail = b"" if end is None else np.array([end], "<u4").tobytes()
    encoder = Encoder.of(name)
    encoder.forget()
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    odd = pc.match_substring_regex(texts, _BLANK_SPACE)
    for s in encoder.special:
        odd = pc.or_(odd, pc.match_substring(texts, s))
    odd = odd.to_numpy(zero_copy_only=False)
    plain = _plain_texts(texts.filter(pa.array(~odd)), encoder) if not odd.all() else iter(())
    for i, other in enumerate(odd):
        yield (encoder.encode(texts[i].as_py()) if other else next(plain)) + tail
