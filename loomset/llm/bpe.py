"""BPE encoding by speculation: longest matches are proposed, pairs verified, and only failures merged.

1. Texts are cut at ASCII white space, and every distinct piece is normalised and split into words by the tokenizer
   file's own normaliser and splitter.
2. A word is proposed as its longest vocabulary entries from left to right.
3. A proposal is the merge rules' own result exactly if every adjacent pair of its tokens is: merging the
   symbols of two neighbours must not join them across their border. ``compatible`` decides that for
   arrays of pairs by undoing merges from the last to the first: at every moment the symbols beside the
   border must not form a merge that comes before the next merge on either side. At equal rank the left
   place merges first.
4. Words with a failing pair are merged rule by rule.

Entries that the rules never produce from their own symbols are not proposed. Special tokens of the file
are found in the raw text and stand for themselves. Truncation and padding of the file are not applied.

The file is read on the driver and broadcast as tables of fixed size (``MAX_FILE`` bounds it). Each task
keeps a bounded number of pieces it has met. A null text has no tokens and decodes to the empty text, as
does a null list; null or unknown ids in a list decode to nothing. Texts of any length are encoded whole.
Repeated rows are encoded row by row, an empty table gives an empty table, extra columns pass through, and
an added column whose name is taken gets a trailing underscore.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import fresh

MAX_FILE = 32 << 20
# Pieces or words a task remembers, and bytes of text it takes in before it hands rows on.
_KNOWN = 600_000
_CHARS = 1 << 21
_SHORT = 64  # symbols up to which scanning beats a heap
_HEAD = 3  # symbols that tell how long an entry can be
_NEVER = np.iinfo(np.int64).max
_NONE = 1 << 62


class Vocabulary:
    """Tables of a BPE file: ids of entries, the two halves of every merged entry, and the merge's rank."""

    def __init__(self, data: dict):
        model = data["model"]
        unlike = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or unlike:
            raise ValueError(f"a plain BPE model is wanted; this one has {unlike or model.get('type')}")
        added = data.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or t["content"].split() != [t["content"]] for t in added):
            raise ValueError("special tokens have to be plain strings without blanks, found in the raw text")
        self.specials = {t["content"]: t["id"] for t in added}
        self.ids = dict(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.texts = {i: s for s, i in [*self.ids.items(), *self.specials.items()]}
        self.frame = json.dumps({**data, "truncation": None, "padding": None, "post_processor": None, "added_tokens": [],
                                 "model": {"type": "BPE", "vocab": {}, "merges": []}})
        self.has_decoder = data.get("decoder") is not None
        size = max(self.ids.values()) + 1
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        self.ranks: dict[tuple[int, int], int] = {}
        self.wholes: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a_id, b_id, whole = self.ids[a], self.ids[b], self.ids[a + b]
            if self.rank[whole] >= 0:
                raise ValueError(f"two merges give {a + b!r}")
            self.left[whole], self.right[whole], self.rank[whole] = a_id, b_id, rank
            self.ranks[a_id, b_id] = rank
            self.wholes.append(whole)
        keys = np.array([a * size + b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks = np.array(list(self.ranks.values()), np.int64)[order]
        self.proposed = {s: i for s, i in self.ids.items() if self._reached[i]}
        self.reach: dict[str, int] = {}  # the longest entry by its first symbols; unlisted heads begin none longer
        for s in self.proposed:
            symbols = s.removesuffix(self.suffix)
            self.reach[symbols[:_HEAD]] = max(len(symbols), self.reach.get(symbols[:_HEAD], 0), _HEAD)

    @cached_property
    def encoder(self) -> _Encoder:
        """Made once in a Python worker, so tasks that follow each other share the pieces it knows."""
        return _Encoder(self)

    @cached_property
    def decoder(self) -> _Decoder:
        return _Decoder(self)

    @cached_property
    def _reached(self) -> np.ndarray:
        """Whether the rules make each entry from its own symbols: its halves are, and nothing joins them earlier."""
        merged = np.flatnonzero(self.rank >= 0)
        free = np.ones(len(self.rank), bool)
        free[merged] = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        for i in merged[np.argsort(self.rank[merged])]:
            free[i] = free[i] and free[self.left[i]] and free[self.right[i]]
        return free

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a number above all ranks where there is none."""
        if not len(self.keys):
            return np.full(len(a), _NEVER)
        key = a * len(self.rank) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether merging the symbols of entries ``a`` and ``b``, side by side, leaves them as they are.

        Only merges before ``limit`` count, by default all.
        """
        fits = np.ones(len(a), bool)
        live = np.arange(len(a))
        limit = np.full(len(a), _NEVER) if limit is None else limit
        while len(live):
            joined = self.pair_ranks(a, b) < limit
            fits[live[joined]] = False
            last_a, last_b = self.rank[a], self.rank[b]
            go = ~joined & ((last_a >= 0) | (last_b >= 0))
            live, a, b, last_a, last_b = live[go], a[go], b[go], last_a[go], last_b[go]
            undo_a = last_a > last_b  # at equal rank the right one was made later
            limit = np.where(undo_a, last_a, last_b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return fits

    def propose(self, word: str) -> list[int] | None:
        """Ids of the longest entries from left to right; None where a symbol is no entry."""
        entry, reach, suffix, n, at, out = self.proposed.get, self.reach.get, self.suffix, len(word), 0, []
        last = n - 1 if suffix else n  # an entry up to the end carries the suffix
        while at < n:
            longest, found = reach(word[at : at + _HEAD], _HEAD), None
            if n - at <= longest:
                found, end = entry(word[at:] + suffix), n
            if found is None:
                for end in range(min(last, at + longest), at, -1):
                    found = entry(word[at:end])
                    if found is not None:
                        break
                else:
                    return None
            out.append(found)
            at = end
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of a word by the rules: the pair of lowest rank, the leftmost of equals, until none is left.

        A symbol that is no entry is left out.
        """
        entry = self.ids.get
        ids = [i for i in map(entry, [*word[:-1], word[-1] + self.suffix]) if i is not None]
        if len(ids) > _SHORT:
            return self._merge_long(ids)
        rank_of, whole_of = self.ranks.get, self.wholes
        ranks = [rank_of(pair, _NONE) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) != _NONE:
            i = ranks.index(rank)
            ids[i : i + 2] = [whole_of[rank]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), _NONE)
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for many symbols: pairs wait in a heap, and one whose symbols have changed is skipped."""
        rank_of, n = self.ranks.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(rank, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := rank_of((a, b))) is not None]
        heapq.heapify(waiting)
        while waiting:
            rank, i, a, b = heapq.heappop(waiting)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            whole = self.wholes[rank]
            ids[i], ids[j], after[i] = whole, -1, after[j]
            if (k := after[i]) < n:
                before[k] = i
            for x, y in ((i, k), (before[i], i)):
                if x >= 0 and y < n and (rank := rank_of((ids[x], ids[y]))) is not None:
                    heapq.heappush(waiting, (rank, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of every word: proposals whose pairs all fit, and exact merges of the rest."""
        proposals = [self.propose(w) for w in words]
        lengths = np.array([len(p) if p else 0 for p in proposals], np.int64)
        flat = np.fromiter((i for p in proposals if p for i in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = np.flatnonzero(owner[1:] == owner[:-1]) if len(flat) else np.empty(0, np.int64)
        pairs, place = np.unique(flat[inside] * len(self.rank) + flat[inside + 1], return_inverse=True)
        fits = self.compatible(*np.divmod(pairs, len(self.rank)))[place]
        failed = set(owner[inside[~fits]].tolist())
        return [self.merge(w) if p is None or i in failed else p for i, (w, p) in enumerate(zip(words, proposals))]


def load_vocabulary(path: str) -> Vocabulary:
    """The tables of a tokenizer file of at most ``MAX_FILE`` bytes."""
    size = Path(path).stat().st_size
    if size > MAX_FILE:
        raise ValueError(f"{path} has {size} bytes; {MAX_FILE} are the most that are broadcast")
    return Vocabulary(json.loads(Path(path).read_text(encoding="utf-8")))


class _Lists:
    """Lists of ids, end to end."""

    def __init__(self):
        self.values, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values.astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int64)])

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at ``places`` end to end, and where each ends."""
        first = self.ends[places]
        sizes = self.ends[places + 1] - first
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.arange(total) + np.repeat(first - ends + sizes, sizes)], ends


class _Encoder:
    """Encodes texts piece by piece and remembers pieces and words, up to a fixed number."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary
        frame = Tokenizer.from_str(vocabulary.frame)
        self.normalizer, self.splitter = frame.normalizer, frame.pre_tokenizer
        if any(self._words(f"a{c}b") != self._words("a") + self._words("b") for c in " \t\n\v\f\r"):
            raise ValueError("a file whose words hold no white space is wanted")
        specials = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self._forget()

    def _forget(self) -> None:
        """Places of pieces and words in their lists of ids. Special tokens count as words, under their id."""
        self.pieces: dict[str, int] = {}
        self.words: dict[str | int, int] = {}
        self.piece_ids, self.word_ids = _Lists(), _Lists()

    def _split(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.splitter.pre_tokenize_str(text) if self.splitter else [(text, (0, len(text)))]

    def _words(self, text: str) -> list[str]:
        return [w for w, _ in self._split(self.normalizer.normalize_str(text) if self.normalizer else text)]

    def _words_of(self, pieces: list[str]) -> tuple[list[str], np.ndarray]:
        """Words of all pieces in order, and how many each piece has.

        Normalising and splitting stay inside blanks, so pieces go through together.
        """
        joined = " ".join(pieces)
        joined = self.normalizer.normalize_str(joined) if self.normalizer else joined
        normal = joined.split(" ")
        if len(normal) != len(pieces):  # some piece holds white space of another kind
            lists = [self._words(p) for p in pieces]
            return [w for x in lists for w in x], np.array([len(x) for x in lists], np.int64)
        found = self._split(joined)
        starts = np.cumsum([0, *[len(p) + 1 for p in normal[:-1]]])
        at = np.fromiter((start for _, (start, _) in found), np.int64, len(found))
        return [w for w, _ in found], np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(pieces))

    def _words_apart(self, piece: str) -> list[str | int]:
        """Words of a piece that holds special tokens, which become their ids, or white space of another kind."""
        specials = self.vocabulary.specials
        cut = self.special.split(piece) if self.special else [piece]
        return [x for s in cut if s for x in ([specials[s]] if s in specials else self._words(s))]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that were not met; the distinct new words among them are verified together."""
        apart = [p for p in pieces if (self.special and self.special.search(p)) or p.split() != [p]]
        if apart:
            left = set(apart)
            pieces = [p for p in pieces if p not in left]
        words, counts = self._words_of(pieces) if pieces else ([], np.empty(0, np.int64))
        lists = [self._words_apart(p) for p in apart]
        words += [x for part in lists for x in part]
        counts = np.concatenate([counts, np.array([len(x) for x in lists], np.int64)])
        known = self.words
        new = [x for x in dict.fromkeys(words) if x not in known]
        strings = [x for x in new if isinstance(x, str)]
        coded = iter(self.vocabulary.encode_words(strings))
        ids = [next(coded) if isinstance(x, str) else [x] for x in new]
        known.update(zip(new, range(len(known), len(known) + len(new))))
        self.word_ids.add(np.fromiter((i for x in ids for i in x), np.int32), np.array([len(x) for x in ids], np.int64))
        flat, ends = self.word_ids.take(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        self.pieces.update(zip([*pieces, *apart], range(len(self.pieces), len(self.pieces) + len(counts))))
        self.piece_ids.add(flat, np.diff(bounds))

    def __call__(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text; pieces are cut and told apart in Arrow, so each distinct one is looked up once."""
        if max(len(self.pieces), len(self.words)) > _KNOWN:
            self._forget()
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        new = [p for p in pieces if p not in self.pieces]
        if new:
            self._learn(new)
        places = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        ids, ends = self.piece_ids.take(places[coded.indices.to_numpy()])
        bounds = np.concatenate([[0], ends])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


class _Decoder:
    """Texts of id lists."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.decoder = Tokenizer.from_str(vocabulary.frame).decoder if vocabulary.has_decoder else None
        self.known = np.zeros(max(vocabulary.texts) + 2, bool)  # the last place stands for ids beyond
        self.known[list(vocabulary.texts)] = True
        self.entries = pa.array([vocabulary.texts.get(i, "") for i in range(len(self.known))], pa.string())

    def __call__(self, lists: pa.ListArray) -> pa.Array:
        known = self.known
        ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
        ids = np.where((ids >= 0) & (ids < len(known)), ids, len(known) - 1)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        kept = known[ids]
        bounds = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])[ends]
        rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), self.entries.take(pa.array(ids[kept])))
        if self.decoder:
            return pa.array([self.decoder.decode(tokens) for tokens in rows.to_pylist()], pa.string())
        return pc.binary_join(rows, " ")


def _blocks(sizes: pa.Array, most: int):
    """Consecutive row ranges of about ``most`` units; a larger row is a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(pc.fill_null(sizes, 0).to_pylist()):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, path: str, text: str = "text", result: str = "ids", decoded: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with the token ids of ``text`` as ``result``; on demand with the text they decode to as ``decoded``.

    ``carry`` names the columns to keep, by default all.
    """
    *added, copy = fresh(docs, *([result, decoded] if decoded else [result]), "_whole")
    names = docs.columns if carry is None else carry
    kept = docs.select(*[f"`{c}`" for c in names]).schema.fields
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches):
        encoder, decoder = shared.value.encoder, shared.value.decoder if decoded else None
        for batch in batches:
            for start, end in _blocks(pc.binary_length(batch.column(len(names))), _CHARS):
                some = batch.slice(start, end - start)
                ids = encoder(some.column(len(names)))
                made = [ids, decoder(ids)] if decoder else [ids]
                yield pa.RecordBatch.from_arrays([*[some.column(i) for i in range(len(names))], *made], [*names, *added])

    shown = docs.select(*[f"`{c}`" for c in names], F.col(f"`{text}`").cast("string").alias(copy))
    types = [T.ArrayType(T.IntegerType()), T.StringType()]
    return shown.mapInArrow(run, T.StructType([*kept, *[T.StructField(c, t) for c, t in zip(added, types)]]))


def decode(rows: DataFrame, path: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids`` as ``result``, special tokens included.

    A file without a decoder joins the entries by one space, as the library does.
    """
    name, copy = fresh(rows, result, "_list")
    names = rows.columns
    shared = rows.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches):
        decoder = shared.value.decoder
        for batch in batches:
            for start, end in _blocks(pc.list_value_length(batch.column(len(names))), _CHARS // 4):
                some = batch.slice(start, end - start)
                out = decoder(some.column(len(names)))
                yield pa.RecordBatch.from_arrays([*[some.column(i) for i in range(len(names))], out], [*names, name])

    shown = rows.select("*", F.col(f"`{ids}`").cast("array<int>").alias(copy))
    return shown.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text they decode to."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = encode(narrow, path, decoded="decoded", carry=["doc_id"])
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
