"""Token ids of whole texts, and documents cut into pieces of them.

White space is dropped by the vocabulary's pre-tokenizer and no rule looks across it, so the ids
of a text are those of its words between white space, one after the other. Frequent words keep
their ids; only words not met before go through the tokenizer.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.textkit import LOWER, slices

END = 1
#: Words kept with their ids in a worker, and the longest word that is kept.
KEPT_WORDS, KEPT_LENGTH = 1 << 19, 64
#: Texts are handled in runs of about so many bytes.
_RUN = 1 << 20
#: U+001C to U+001F separate words for str.split, but not for the tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_PLAIN_WORDS = re.compile("[^ \t\r\n]+")
_ABOVE = re.compile("[\u0300-\U0010ffff]")
_PLAIN = re.compile("[a-zà-öø-ÿ]+")
_MARKS = frozenset(".,;:!?")
_LOWER = bytes(LOWER.tolist())

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
)
PIECE_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary, which is installed alike on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        vocab = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocab.values()) + 1, bool)
        self._ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words. A word and the punctuation mark after it are told apart by the
        vocabulary's rules, so the word alone is looked up or learnt."""
        marked = {w for w in words if w[-1] in _MARKS and w[:-1].isalpha()}
        bare = (words - marked).union((w[:-1] for w in marked), (w[-1] for w in marked)).difference(self._known)
        plain = [w for w in bare if _PLAIN.fullmatch(w)]
        other = list(bare.difference(plain))
        encoded = self._tokenizer.encode_batch_fast(other, add_special_tokens=False)
        out = {w: np.asarray(e.ids, "<u4").tobytes() for w, e in zip(other, encoded)}
        out.update(self._learn_plain(plain))
        for w in marked:
            stem, mark = w[:-1], w[-1]
            out[w] = (out.get(stem) or self._known.get(stem, b"")) + (out.get(mark) or self._known.get(mark, b""))
        return out

    def _learn_plain(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of small letters: one text of all of them, cut where a token ends a word."""
        if not words:
            return {}
        line = self._tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.asarray(line.ids, "<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the vocabulary splits plain words")
        raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return {w: raw[a:b] for w, a, b in zip(words, cuts, cuts[1:])}

    def ids(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text; null has none."""
        split = [_words(t) if t else [] for t in texts]
        known = self._known
        learnt = self._learn(set().union(*split).difference(known))
        known.update(learnt)
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        # The words met first stay: they are the frequent ones. Long ones never do.
        room = max(KEPT_WORDS - len(known) + len(learnt), 0)
        for word in learnt:
            if room and len(word) <= KEPT_LENGTH:
                room -= 1
            else:
                del known[word]
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary, with the words it knows: a worker keeps it between tasks."""
    return Encoder(path)


def _words(text: str) -> list[str]:
    """The words between white space. Capital letters are made small where that cannot change
    what the vocabulary's own normalisation gives: no combining marks, no special tokens."""
    if "<|" not in text:
        if text.isascii():
            text = text.lower()
        elif not _ABOVE.search(text):
            text = text.encode().translate(_LOWER).decode()
    return _PLAIN_WORDS.findall(text) if any(c in text for c in _SEPARATORS) else text.split()


def pieces(documents: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """One row per piece of at most ``limit`` of a document's ids (its text's, then the end
    token); ``tokenizer`` is the file's path on executors. A null text has the end token alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).ids, END.to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, "text", _RUN):
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text").to_pylist())):
                    ids += end
                    total = len(ids) // 4
                    for number, start in enumerate(range(0, total, limit)):
                        piece = ids[4 * start : 4 * (start + limit)]
                        rows.append((doc, number, start, len(piece) // 4, zlib.crc32(piece), total))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PIECES.types)], schema=PIECES)

    return documents.select("doc_id", "text").mapInArrow(run, PIECE_DDL)
