"""Token ids of the tokenizers library, made once per distinct word of a block of texts.

A text is cut at single spaces; such a piece has the same ids alone as inside its text (see
``pretokens``).  Arrow cuts a block's texts, numbers their distinct words and strings the words' ids together
again; only the library's calls, one for ``STRUNG`` distinct words, pass through Python.  Texts in which a space
stands inside a longer run of white space, and texts that hold an added token's string, go to the library whole."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.pretokens import AMBIGUOUS, load_vocabulary

#: Words that each generation of a worker's memory holds, and the length from which on a word isn't kept.
REMEMBERED, LONGEST = 150_000, 60
#: New words that go to the library as one text.
STRUNG = 500
#: White space as Python's ``str.isspace`` has it, which includes all that the pattern's ``\\s`` matches.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


class Recent:
    """Values of the words met lately; those of new words are made many at a time.

    Two generations of at most ``limit`` words: when the young one is full it becomes the old one, so frequent
    words stay and a worker's memory does not grow with the corpus."""

    def __init__(self, make: Callable[[list[str]], list], limit: int = REMEMBERED, longest: int = LONGEST):
        self.make, self.limit, self.longest = make, limit, longest
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, rows: list[list[str]]) -> list[list]:
        """The values of each row's words."""
        young, old = self.young, self.old
        missing = {w for row in rows for w in row if w not in young}
        new = [w for w in missing if w not in old]
        young.update((w, old[w]) for w in missing if w in old)
        young.update(zip(new, self.make(new) if new else ()))
        out = [[young[w] for w in row] for row in rows]
        for w in new:
            if len(w) > self.longest:
                del young[w]
        if len(young) > self.limit:
            self.old, self.young = young, {}
        return out


def id_width(path: str) -> int:
    """Bytes of an id on disk: 2 where all ids of the file fit, else 4."""
    spec = load_vocabulary(path)
    return 2 if max([*spec["vocab"].values(), *spec["added"].values()]) < 1 << 16 else 4


class LibraryIds:
    """``texts -> ids`` (little-endian, ``width`` bytes each) for one byte-level BPE file; special
    tokens' strings inside texts are handled as the library's default, none are added."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.width = Tokenizer.from_file(path), id_width(path)
        spec = load_vocabulary(path)
        self.added = [*spec["added"]]
        sizes = {i: len(t) for t, i in spec["vocab"].items()} | {i: len(t.encode()) for t, i in spec["added"].items()}
        self.sizes = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)])
        #: First words and whole texts met lately.
        self.starts = Recent(self.alone, remembered)

    def whole(self, text: str) -> bool:
        """Whether a text goes to the library as it is."""
        return bool(AMBIGUOUS.search(text)) or any(a in text for a in self.added)

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        apart = [self.whole(t) for t in texts]
        for ids_of, at in ((self.known, [i for i, x in enumerate(apart) if x]), (self.cut, [i for i, x in enumerate(apart) if not x])):
            for i, ids in zip(at, ids_of([texts[i] for i in at]) if at else ()):
                out[i] = ids
        return out

    def known(self, texts: list[str]) -> list[bytes]:
        return self.starts([texts])[0]

    def alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes()
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def cut(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that may be cut at spaces."""
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        words, number = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # a text's first word has no space before it
        first, of = np.unique(number[bounds[:-1]], return_inverse=True)
        starts = self.known(words.take(pa.array(first)).to_pylist())
        number[bounds[:-1]] = len(words) + of
        ids = pa.concat_arrays([self.behind_space(words), pa.array(starts, pa.large_binary())]).take(pa.array(number))
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int64, len(ids) + 1, 8 * ids.offset)[bounds].tolist()
        return [data[a:b].to_pybytes() if b > a else b"" for a, b in zip(at, at[1:])]

    def behind_space(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of each word with a space before it.  Words that begin and end with other signs than white space have
        the same ids wherever they stand behind one another; they are strung together to texts of ``STRUNG`` words,
        whose ids are cut where the words end.  A call to the library for each word costs more than its ids."""
        plain = pc.and_(pc.equal(pc.utf8_trim(words, characters=SPACES), words), pc.not_equal(words, ""))
        strung = words.filter(plain)
        sizes = pc.binary_length(strung).to_numpy() + 1
        cuts = [*range(0, len(strung), STRUNG), len(strung)]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), strung), pa.scalar(" ", pa.large_string()))
        data, counts = [], [np.zeros(1, np.int64)]
        for text, a, b in zip(texts, cuts, cuts[1:]):
            ids = np.array(self.library.encode_batch_fast([" " + text.as_py()], add_special_tokens=False)[0].ids)
            stop = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes[a:b])) + 1
            data.append(ids.astype(f"<u{self.width}").tobytes())
            counts.append(np.diff(stop, prepend=0))
        ends = np.cumsum(np.concatenate(counts)) * self.width
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(strung), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(data))])
        mask = plain.to_numpy(zero_copy_only=False)
        place = np.where(mask, np.cumsum(mask) - 1, len(strung) + np.cumsum(~mask) - 1)
        odd = self.alone([" " + w for w in words.filter(pc.invert(plain)).to_pylist()])
        return pa.concat_arrays([made, pa.array(odd, pa.large_binary())]).take(pa.array(place))


@lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    """One per worker and file."""
    return LibraryIds(path)
