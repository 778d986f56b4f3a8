"""Byte-level BPE encoding of many texts, each distinct piece once."""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space after a character that is no white space always starts a new
#: pre-token of the byte-level pattern, whatever stands around it, so the
#: pieces between such spaces encode independently of each other.
BOUNDARY = re.compile(r"(?<=\S) ")
#: Texts with other spaces: at the start, or behind white space.
OTHER_SPACE = r"^ |[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
#: A word and what follows it in its piece: letters end a pre-token before any of these characters.
WORD = r"(?s)^(?P<word>[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<tail>(?:[\n.,;:!?%&*#$|()\-].*)?)$"


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(others)}}


def strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[start:start + size]`` of all pairs, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class PieceEncoder:
    """Encodes texts with a tokenizers file; ids of words met before come from a bounded cache.

    Only for byte-level BPE files without normalizer and prefix space, whose
    pre-tokens take at most one leading space (checked when the file is read).
    Pieces are split and counted in Arrow, and only distinct words and tails
    are looked up and encoded.
    """

    #: Bound of the cache (about 200 bytes an entry; a full one starts anew) and the longest key kept.
    WORDS, LONGEST = 1_000_000, 64

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        before = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer is not None or type(before).__name__ != "ByteLevel" or before.add_prefix_space:
            raise ValueError(f"{path}: no plain byte-level tokenizer")
        self.tokenizer.encode_special_tokens = special_as_text
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.words: dict[str, bytes] = {}

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each whole text, no special tokens added."""
        out: list = [None] * len(texts)
        for rows, leads, bounds, index, flat, starts, sizes in self._pieces(texts):
            ends = np.append(0, np.cumsum(sizes[index]))[bounds].tolist()
            ids = ragged(flat, starts[index], sizes[index])
            for k, (row, lead) in enumerate(zip(rows, leads)):
                out[row] = np.concatenate([np.frombuffer(lead, "<u4"), ids[ends[k]:ends[k + 1]]])
        return out

    def lengths(self, texts: list[str] | pa.Array) -> np.ndarray:
        """Number of ids of each whole text; no ids are built."""
        out = np.zeros(len(texts), np.int64)
        for rows, leads, bounds, index, _, _, sizes in self._pieces(texts):
            ends = np.append(0, np.cumsum(sizes[index]))[bounds]
            out[rows] = np.diff(ends) + np.fromiter(map(len, leads), np.int64, len(leads)) // 4
        return out

    def _pieces(self, texts):
        """For the regular texts and the others: row numbers, ids of the first pieces, bounds and numbers of the
        following pieces, and the ids of the distinct ones as one array with starts and sizes."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False).astype(bool)
        for rows in (np.flatnonzero(~odd), np.flatnonzero(odd)):
            if not len(rows):
                continue
            own = texts.take(pa.array(rows))
            if odd[rows[0]]:
                split = pa.array([BOUNDARY.split(t) for t in strings(own)], pa.list_(pa.string()))
            else:
                split = pc.split_pattern(own, " ")
            bounds, pieces = split.offsets.to_numpy(), split.values
            later = np.ones(len(pieces), bool)
            later[bounds[:-1]] = False
            coded = pieces.filter(pa.array(later)).dictionary_encode()
            leads = self._encoded(strings(pieces.take(pa.array(bounds[:-1]))))
            yield (rows, leads, bounds - np.arange(len(bounds)), coded.indices.to_numpy(), *self._distinct(coded.dictionary))

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces that follow a space, as one array with starts and sizes: a word and its tail encode apart."""
        parts = pc.extract_regex(pieces, WORD)
        word = pc.struct_field(parts, 0)
        whole = pc.is_null(parts)
        # A piece of another form is one key, told from words by its space.
        heads = pc.if_else(whole, pc.binary_join_element_wise("", pieces, " "), word).dictionary_encode()
        tails = pc.if_else(whole, "", pc.struct_field(parts, 1)).dictionary_encode()
        values = self._known([*strings(heads.dictionary), *strings(tails.dictionary)])
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        starts = np.cumsum(sizes) - sizes
        use = np.stack([heads.indices.to_numpy(), tails.indices.to_numpy() + len(heads.dictionary)], axis=1).ravel()
        flat = ragged(np.frombuffer(b"".join(values), "<u4"), starts[use], sizes[use])
        both = sizes[use].reshape(-1, 2).sum(axis=1)
        return flat, np.cumsum(both) - both, both

    def _known(self, keys: list[str]) -> list[bytes]:
        values = list(map(self.words.get, keys))
        missing = [k for k, v in enumerate(values) if v is None]
        if len(self.words) + len(missing) > self.WORDS:
            self.words.clear()
        plain = [k for k in missing if not keys[k][:1].isalpha()]
        for k, ids in zip(plain, self._encoded([keys[k] for k in plain])):
            values[k] = ids
        model, alphabet, space = self.model, self.alphabet, self.alphabet[32]
        for k in missing:
            key = keys[k]
            if values[k] is None:
                # Letters behind a space are one pre-token: the model takes them as they are.
                name = space + (key if key.isascii() else key.encode().decode("latin-1").translate(alphabet))
                values[k] = array("I", [t.id for t in model.tokenize(name)]).tobytes()
            if len(key) <= self.LONGEST:
                self.words[key] = values[k]
        return values

    def _encoded(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 5000):
            out += [array("I", x.ids).tobytes() for x in
                    self.tokenizer.encode_batch_fast(texts[at:at + 5000], add_special_tokens=False)]
        return out

    def decode(self, ids) -> str:
        return self.tokenizer.decode(list(map(int, ids)), skip_special_tokens=False)


@functools.lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False) -> PieceEncoder:
    """One encoder for each Python worker."""
    return PieceEncoder(path, special_as_text)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of an installed tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
