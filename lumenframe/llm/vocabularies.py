"""Public vocabularies inside tasks: each text unit is encoded once and remembered.

A byte-level BPE never merges across the pieces its pattern cuts a text into,
and a space behind a visible character always starts a new piece. Texts are
therefore cut there, and a unit that recurs is encoded by the library once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units a worker remembers; when full, those in use stay and the others go.
REMEMBERED = 250_000
#: A space before white space or at the end: only there a cut may be wrong.
_ODD_SPACE = re.compile(r" (?:\s|$)")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Remember(dict):
    """Answers by unit; ``ask`` gives those of a list of new units."""

    def __init__(self, ask: Callable[[list[str]], Iterable]):
        super().__init__()
        self.ask = ask

    def learn(self, units: Iterable) -> None:
        wanted = set(units)
        new = [u for u in wanted if u not in self]
        if len(self) + len(new) > REMEMBERED:
            used = {u: self[u] for u in wanted if u in self}
            self.clear()
            self.update(used)
        for at in range(0, len(new), 50_000):
            some = new[at : at + 50_000]
            self.update(zip(some, self.ask(some), strict=True))


@lru_cache(1)
def in_worker(kind: type, path: str):
    """One encoder for all tasks of a worker process that ask for its kind and file; the next kind takes its place, with what it remembers."""
    return kind(path)


def units(text: str) -> list[str]:
    """Pieces of a text that can be encoded one by one; joined they are the text."""
    pieces = text.split(" ")
    if not _ODD_SPACE.search(text):
        return pieces[:1] + [" " + p for p in pieces[1:]]
    out = [pieces[0]]
    for p in pieces[1:]:
        cut = (p and not p[0].isspace()) or (out[-1] and not out[-1][-1].isspace())
        if cut:
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


#: Units in a string that is encoded at once; a unit of this form starts at the one token that starts with its space.
GROUP = 1000
_PLAIN = r"^[^\s\pZ\x1c-\x1f\x{85}][^ ]*$"
#: Units whose ids a tokenizer remembers, packed in two arrays.
KNOWN_UNITS = 1_000_000


def _lists(sizes: np.ndarray, flat: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.array(flat, pa.int32()))


class ByteTokenizer:
    """Token ids of whole texts by a ``tokenizers`` file, as 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = pa.array([], pa.large_string())
        self.ids = _lists(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32))

    def _encoded(self, strings: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, dtype="<i4") for e in found]

    def _listed(self, strings: list[str]) -> pa.LargeListArray:
        ids = self._encoded(strings)
        return _lists(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)), np.concatenate([np.zeros(0, dtype="<i4"), *ids]))

    def _new(self, units: pa.Array) -> pa.LargeListArray:
        """Ids of units that follow a space, many of them in one string."""
        plain = pc.match_substring_regex(units, _PLAIN).to_numpy(zero_copy_only=False)
        whole, sizes, flat = units.filter(pa.array(plain)).to_pylist(), [], []
        groups = [whole[at : at + GROUP] for at in range(0, len(whole), GROUP)]
        for at in range(0, len(groups), 50):
            some = groups[at : at + 50]
            for group, ids in zip(some, self._encoded([" " + " ".join(g) for g in some]), strict=True):
                starts = np.flatnonzero(self.opens[ids])
                if len(starts) != len(group) or starts[0]:  # not a byte-level vocabulary
                    one_by_one = self._encoded([" " + u for u in group])
                    sizes.append(np.fromiter(map(len, one_by_one), dtype=np.int64, count=len(group)))
                    flat += one_by_one
                else:
                    sizes.append(np.diff(starts, append=len(ids)))
                    flat.append(ids)
        none = np.zeros(0, dtype=np.int64)
        done = _lists(np.concatenate([none, *sizes]), np.concatenate([none.astype("<i4"), *flat]))
        others = self._listed([" " + u for u in units.filter(pa.array(~plain)).to_pylist()])
        place = np.empty(len(units), dtype=np.int64)
        place[plain], place[~plain] = np.arange(len(done)), len(done) + np.arange(len(others))
        return pa.concat_arrays([done, others]).take(pa.array(place))

    def unit_ids(self, units: pa.Array) -> pa.LargeListArray:
        """Ids of different units that follow a space; new ones are remembered."""
        at = pc.index_in(self.names, value_set=units)  # the side that is made a table of is the small one
        which = at.drop_null().to_numpy()
        known, place = np.zeros(len(units), dtype=bool), np.zeros(len(units), dtype=np.int64)
        known[which], place[which] = True, np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        new = units.filter(pa.array(~known))
        place[~known] = len(self.names) + np.arange(len(new))
        names, ids = pa.concat_arrays([self.names, new]), pa.concat_arrays([self.ids, self._new(new)])
        found = ids.take(pa.array(place))
        self.names, self.ids = (names, ids) if len(names) <= KNOWN_UNITS else (units, found)
        return found

    def _heads(self, texts: list[str]) -> tuple[list[str], pa.LargeListArray]:
        """What follows each text's first unit, space by space, and the ids of the text up to there.

        Units are cut in one go from what follows; a text with odd spaces is cut here
        and one that spells an added token, which ends the piece before it, not at all.
        """
        rests, heads, cut = [], [], {}
        for n, t in enumerate(texts):
            rest = ""
            if not any(a in t for a in self.added):
                if _ODD_SPACE.search(t):
                    cut[n] = units(t)
                    t = ""
                else:
                    t, _, rest = t.partition(" ")
            heads.append(t)
            rests.append(rest)
        whole = self._listed(heads)
        if not cut:
            return rests, whole
        pieces = [u for us in cut.values() for u in us]
        spaced = sorted({u[1:] for u in pieces if u[:1] == " "})
        others = sorted({u for u in pieces if u[:1] != " "})
        number = {" " + u: k for k, u in enumerate(spaced)} | {u: len(spaced) + k for k, u in enumerate(others)}
        parts = pa.concat_arrays([self.unit_ids(pa.array(spaced, pa.large_string())), self._listed(others)])
        taken = parts.take(pa.array([number[u] for u in pieces], pa.int64()))
        sizes = taken.value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum([len(us) for us in cut.values()])
        joined = _lists(np.add.reduceat(sizes, np.concatenate([[0], ends[:-1]])), taken.flatten().to_numpy())
        place = np.arange(len(texts))
        place[list(cut)] = len(texts) + np.arange(len(cut))
        return rests, pa.concat_arrays([whole, joined]).take(pa.array(place))

    def encode(self, texts: list[str], end: Sequence[int] = ()) -> pa.ListArray:
        """Ids of each text, and ``end`` behind them."""
        n = len(texts)
        if not n:
            return pa.array([], pa.list_(pa.int32()))
        rests, heads = self._heads(texts)
        pieces = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        # an empty rest is cut into one empty piece, which is no unit
        has = np.fromiter(map(bool, rests), dtype=bool, count=n)
        n_pieces = np.diff(pieces.offsets.to_numpy()).astype(np.int64)
        cut = pieces.flatten().filter(pa.array(np.repeat(has, n_pieces))).dictionary_encode()
        n_pieces, codes = np.where(has, n_pieces, 0), cut.indices.to_numpy()
        last = _lists(np.array([len(end)]), np.array(end, dtype=np.int32))
        answers = pa.concat_arrays([self.unit_ids(cut.dictionary), heads, last])
        # which answer stands where: a text's head, its units, the end
        starts, doc = np.cumsum(n_pieces) - n_pieces + 2 * np.arange(n), np.repeat(np.arange(n), n_pieces)
        order = np.empty(len(codes) + 2 * n, dtype=np.int64)
        order[np.arange(len(codes)) + 2 * doc + 1] = codes
        order[starts] = len(cut.dictionary) + np.arange(n)
        order[starts + n_pieces + 1] = len(cut.dictionary) + n
        sizes = answers.value_lengths().to_numpy().astype(np.int64)[order]
        offsets = np.concatenate([[0], np.cumsum(np.add.reduceat(sizes, starts))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), answers.take(pa.array(order)).flatten())
