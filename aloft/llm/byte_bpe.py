"""Byte-level BPE encoding and decoding by prefix dynamic programming.

A text is cut into pieces by the tokenizer's pattern, and every piece is encoded
alone.  A byte-level BPE vocabulary merges the adjacent pair of the lowest rank until
none is left, and whether two tokens can stand side by side in a result depends on
those two alone.  So each byte prefix of a piece has exactly one valid last token: the
one whose left neighbour is the last token of the prefix before it.  ``last[p]`` is
that token for the first p bytes; following it back from the end gives the ids.

The stored last tokens of all prefixes make two things exact and cheap:

* an append continues the table: no entry of an earlier prefix changes;
* an edit keeps the pieces before it, the table of the piece it falls into up to the
  first changed byte, and all pieces behind it from the first common piece start on.

A piece that is a token itself is that token.  A null or empty text has no ids.
Strings that look like special tokens are ordinary text, nothing is cut off.  Repeated
rows are encoded alike, an empty table gives an empty result.  ``encode`` replaces a
column named like its result (in any case) and keeps all others; ``decode`` turns null
ids into null bytes and raises for an id that the vocabulary does not have.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import textops

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: the left neighbour of a piece's first token
BOUNDARY = (1 << 30) - 1
#: entries of one generation of the memory of pairs; two generations are kept
PAIR_MEMORY = 100_000
#: slots of the table of pairs that batches use (a power of two); a later pair takes an earlier one's slot
PAIR_SLOTS = 1 << 20
#: merge stories of tokens kept at once
STORY_MEMORY = 1 << 14
#: pieces of more bytes are encoded one by one
LONGEST_TOGETHER = 64
#: bytes of text cut into pieces and encoded at once
CHUNK_BYTES = 1 << 19
#: characters behind a piece's end that can have a say in where it ends: contractions ('re) and a
#: run of white space that gives its last character to the next piece look at most this far
LOOK_AHEAD = 4


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def piece_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(file: str) -> dict[bytes, int]:
    """Token bytes -> rank (id) of a ranks file: base64 and number on every line."""
    with open(file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


@dataclass
class Encoded:
    """An encoded text that can be appended to and edited."""

    text: str
    starts: list[int]  #: first character of every piece
    tables: list[array]  #: last tokens of every piece's byte prefixes
    ids: list[list[int]]  #: ids of every piece

    def all_ids(self) -> list[int]:
        return [i for ids in self.ids for i in ids]


class PrefixTokenizer:
    """Last tokens of all byte prefixes for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        if max(self.token) != len(self.token) - 1:
            raise ValueError("the ranks are not consecutive from 0")
        self.split = regex.compile(pattern).findall
        self.match = regex.compile(pattern).search
        self.longest = max(map(len, ranks))
        #: finds all places of all tokens in some bytes (one character a byte)
        finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.merge(token) == [token]:  # else merges never make it: it can only be a whole piece
                finder.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        finder.make_automaton()
        self.places = finder.iter
        #: (token before or BOUNDARY, token) as one number -> whether they can stand side by side
        self.pairs: dict[int, bool] = {}
        self.old_pairs: dict[int, bool] = {}
        self.stories: dict[int, tuple] = {}
        self._plant([t for t in ranks if self.merge(t) == [t]])
        #: pairs by slot (prefix token * tokens + token), and whether they can stand side by side
        self.slot_pair = np.full(PAIR_SLOTS, -1, dtype=np.int64)
        self.slot_ok = np.zeros(PAIR_SLOTS, dtype=bool)

    def merge(self, piece: bytes) -> list[bytes]:
        """Plain BPE on a few bytes: lowest rank first, the leftmost among equals."""
        rank, none = self.ranks.get, len(self.token)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], none)
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], none)
        return parts

    def story(self, token: int) -> tuple[list[int], list[bytes], list[bytes]]:
        """How merges make a token of its bytes: the rank of each merge, and the first and the last part
        before it (and at the end)."""
        found = self.stories.get(token)
        if found is None:
            whole = self.token[token]
            parts, ranks, firsts, lasts = [whole[i:i + 1] for i in range(len(whole))], [], [whole[:1]], [whole[-1:]]
            while len(parts) > 1:
                least, at = min((r, i) for i in range(len(parts) - 1)
                                if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None)
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                ranks.append(least)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            if len(self.stories) >= STORY_MEMORY:
                self.stories.clear()
            found = self.stories[token] = ranks + [len(self.token)], firsts, lasts
        return found

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether merges of two tokens' bytes make just these tokens: both stories are told in the order of
        ranks, and no merge of their neighbouring parts may come before what is told next."""
        (here, _, lasts), (there, firsts, _) = self.story(left), self.story(right)
        i = j = 0
        none, rank = len(self.token), self.ranks.get
        while True:
            across, a, b = rank(lasts[i] + firsts[j], none), here[i], there[j]
            if across < a and across <= b:  # the leftmost of equal ranks is merged first
                return False
            if a == b == none:
                return True
            if a <= b:
                i += 1
            else:
                j += 1

    def compatible(self, pair: int) -> bool:
        """Whether a token can follow another (or a boundary) in a result."""
        ok = self.old_pairs.get(pair)
        if ok is None:
            before = pair >> 32
            # at a boundary all fit: tokens that no merge makes are not looked for
            ok = before == BOUNDARY or self.stays_apart(before, pair & 0xFFFFFFFF)
        if len(self.pairs) >= PAIR_MEMORY:
            self.old_pairs, self.pairs = self.pairs, {}
        self.pairs[pair] = ok
        return ok

    def extend(self, piece: bytes, table: array, known: int) -> array:
        """The last tokens of all prefixes of ``piece``, given those of its first ``known`` bytes."""
        pairs = self.pairs
        last = table[:known + 1]
        last.extend([-1] * (len(piece) - known))  # -1: not found yet
        base = max(0, known - self.longest + 1)
        for end, (token, before) in self.places(piece[base:].decode("latin-1")):
            end += base
            if last[end + 1] < 0:
                pair = last[end - before] << 32 | token
                ok = pairs.get(pair)
                if ok is None:
                    ok = self.compatible(pair)
                    pairs = self.pairs
                if ok:
                    last[end + 1] = token
        return last

    def table(self, piece: bytes) -> array:
        return self.extend(piece, array("i", [BOUNDARY]), 0)

    def follow(self, piece: bytes, table: array, end: int | None = None) -> list[int]:
        """Ids of the piece's first ``end`` bytes, read back from their last tokens."""
        p, ids = len(piece) if end is None else end, []
        whole = self.ranks.get(piece[:p])
        if whole is not None:
            return [whole]
        while p:
            t = table[p]
            ids.append(t)
            p -= len(self.token[t])
        ids.reverse()
        return ids

    # -- many pieces at once ---------------------------------------------------------------------

    def _plant(self, tokens: list[bytes]) -> None:
        """The trie of all tokens as arrays: nodes with children come first and have a row of children."""
        children: list[dict] = [{}]
        rank = [-1]
        for token in tokens:
            node = 0
            for byte in token:
                below = children[node].get(byte)
                if below is None:
                    below = children[node][byte] = len(children)
                    children.append({})
                    rank.append(-1)
                node = below
            rank[node] = self.ranks[token]
        order = np.argsort([not c for c in children], kind="stable")
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.inner = sum(1 for c in children if c)
        self.child = np.zeros((self.inner, 256), dtype=np.int32)  # 0, the root, is no node's child
        for node, own in enumerate(children):
            for byte, below in own.items():
                self.child[place[node], byte] = place[below]
        self.node_rank = np.array(rank, dtype=np.int32)[order]
        self.size = np.array([len(self.token[i]) for i in range(len(self.token))], dtype=np.int32)

    def _places(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first byte, token) of all tokens in ``data`` that end by their piece's ``stop``."""
        at, node, depth = np.arange(len(data), dtype=np.int32), np.zeros(len(data), dtype=np.int32), 0
        starts, tokens = [], []
        while len(at):
            node = self.child[node, data[at + depth]]
            depth += 1
            keep = node > 0
            at, node = at[keep], node[keep]
            rank = self.node_rank[node]
            keep = rank >= 0
            starts.append(at[keep])
            tokens.append(rank[keep])
            keep = (node < self.inner) & (at + depth < stop[at])
            at, node = at[keep], node[keep]
        return np.concatenate(starts), np.concatenate(tokens)

    def _side_by_side(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token can follow the one before it (-2: nothing is before it)."""
        ok = before == -2
        some = np.flatnonzero(~ok)
        pair = before[some].astype(np.int64) * len(self.token) + token[some]
        slot = (pair * 0x9E3779B97F4A7C1 >> 20) & (PAIR_SLOTS - 1)
        known = self.slot_pair[slot] == pair
        ok[some[known]] = self.slot_ok[slot[known]]
        if not known.all():
            new, back = np.unique(pair[~known], return_inverse=True)
            left, right = np.divmod(new, len(self.token))
            found = np.array([self.compatible(a << 32 | b) for a, b in zip(left.tolist(), right.tolist())])
            slot = (new * 0x9E3779B97F4A7C1 >> 20) & (PAIR_SLOTS - 1)
            self.slot_pair[slot], self.slot_ok[slot] = new, found
            # two new pairs of one slot: the answer must be that of the pair that is there
            self.slot_ok[slot] = found[np.searchsorted(new, self.slot_pair[slot])]
            ok[some[~known]] = found[back]
        return ok

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids): the last tokens of all prefixes, by prefix length."""
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        first = (np.cumsum(size) - size).astype(np.int32)
        size = size.astype(np.int32)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        at, token = self._places(data, (first + size)[piece])
        # a piece of n bytes has n + 1 prefixes: their places in ``last``
        begin = first + np.arange(len(pieces), dtype=np.int32)
        here = at + piece[at]
        length = self.size[token]
        level = (here - begin[piece[at]] + length).astype(np.uint8)
        order = np.argsort(level, kind="stable")
        here, token, there = here[order], token[order], (here + length)[order]
        cuts = np.searchsorted(level[order], np.arange(1, LONGEST_TOGETHER + 2))
        last = np.full(len(data) + len(pieces), -1, dtype=np.int32)
        last[begin] = -2
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                ok = self._side_by_side(last[here[i:j]], token[i:j])
                last[there[i:j][ok]] = token[i:j][ok]
        # back from the end of every piece
        place, which = begin + size, np.arange(len(pieces))
        steps = []
        while len(which):
            t = last[place]
            steps.append((which, t))
            place = place - self.size[t]
            more = place > begin[which]
            place, which = place[more], which[more]
        count = np.bincount(np.concatenate([w for w, _ in steps]), minlength=len(pieces))
        end = np.cumsum(count)
        ids = np.empty(int(end[-1]), dtype=np.int32)
        for k, (which, t) in enumerate(steps):
            ids[end[which] - 1 - k] = t
        return count, ids

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids) of some pieces."""
        raw = [p.encode("utf-8") for p in pieces]
        whole = list(map(self.ranks.get, raw))
        count = np.ones(len(raw), dtype=np.int64)
        short = [k for k, w in enumerate(whole) if w is None and len(raw[k]) <= LONGEST_TOGETHER]
        parts: dict[int, list[int]] = {k: self.follow(raw[k], self.table(raw[k])) for k, w in enumerate(whole)
                                       if w is None and len(raw[k]) > LONGEST_TOGETHER}
        for k, ids in parts.items():
            count[k] = len(ids)
        if short:
            n, found = self._together([raw[k] for k in short])
            count[short] = n
        end = np.cumsum(count)
        out = np.empty(int(end[-1]) if len(end) else 0, dtype=np.int32)
        direct = [k for k, w in enumerate(whole) if w is not None]
        out[end[direct] - 1] = [whole[k] for k in direct]
        if short:
            inside = np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(end[short] - n, n) + inside] = found
        for k, ids in parts.items():
            out[end[k] - len(ids):end[k]] = ids
        return count, out

    def encode_texts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ends, all ids) of whole texts; every different piece is encoded once."""
        pieces: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                pieces += self.split(text)
            ends.append(len(pieces))
        different = list(dict.fromkeys(pieces))
        number = dict(zip(different, range(len(different))))
        which = np.fromiter(map(number.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        count, ids = self.encode_pieces(different)
        n = count[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        inside = np.arange(int(upto[-1])) - np.repeat(upto[:-1], n)
        return upto[ends], ids[np.repeat((np.cumsum(count) - count)[which], n) + inside]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text."""
        return self.encode_texts([text])[1].tolist()

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    # -- texts that change ---------------------------------------------------------------------

    def open(self, text: str) -> Encoded:
        """An encoding that keeps its last tokens, for appends and edits."""
        return self._from(text, 0, Encoded("", [], [], []), 0, len(text))[0]

    def append(self, state: Encoded, more: str) -> Encoded:
        return self.edit(state, len(state.text), len(state.text), more)

    def edit(self, state: Encoded, start: int, end: int, new: str) -> Encoded:
        """The encoding with characters ``start`` to ``end`` replaced by ``new``; only pieces near them
        are cut and encoded again."""
        return self.edit_counted(state, start, end, new)[0]

    def edit_counted(self, state: Encoded, start: int, end: int, new: str) -> tuple[Encoded, int]:
        """The same, and the number of bytes whose last tokens had to be found."""
        text = state.text[:start] + new + state.text[end:]
        # the last piece that cannot have looked at what changes ends LOOK_AHEAD before it
        first = max(0, bisect_right(state.starts, max(0, start - LOOK_AHEAD)) - 1)
        return self._from(text, first, state, len(new) - (end - start), start + len(new))

    def _from(self, text: str, first: int, old: Encoded, shift: int, changed_to: int) -> tuple[Encoded, int]:
        starts, tables, ids = old.starts[:first], old.tables[:first], old.ids[:first]
        at = old.starts[first] if first < len(old.starts) else 0
        behind = {s + shift: k for k, s in enumerate(old.starts) if s + shift >= changed_to}
        before = {s: k for k, s in enumerate(old.starts[first:], first)}
        found = 0
        while at < len(text):
            if at >= changed_to and at in behind:  # from here on the cut and the texts are the old ones
                k = behind[at]
                starts += [s + shift for s in old.starts[k:]]
                tables += old.tables[k:]
                ids += old.ids[k:]
                break
            m = self.match(text, at)
            if m is None:
                break
            piece = m.group().encode("utf-8")
            known, table = 0, array("i", [BOUNDARY])
            if m.start() in before:  # an old piece began here: its prefixes up to the first other byte stay
                k = before[m.start()]
                stop = old.starts[k + 1] if k + 1 < len(old.starts) else len(old.text)
                was, table = old.text[old.starts[k]:stop].encode("utf-8"), old.tables[k]
                both = min(len(was), len(piece), len(table) - 1)
                same = np.frombuffer(was, np.uint8, both) == np.frombuffer(piece, np.uint8, both)
                known = both if same.all() else int(same.argmin())
            found += len(piece) - known
            table = self.extend(piece, table, known)
            starts.append(m.start())
            tables.append(table)
            ids.append(self.follow(piece, table))
            at = m.end()
        return Encoded(text, starts, tables, ids), found


_TOKENIZERS: dict[str, PrefixTokenizer] = {}
_TOKENS: dict[str, list[bytes]] = {}


def tokenizer(vocabulary: str = VOCABULARY) -> PrefixTokenizer:
    """One tokenizer for each vocabulary in a worker process."""
    if vocabulary not in _TOKENIZERS:
        _TOKENIZERS[vocabulary] = PrefixTokenizer(read_ranks(vocabulary_path(vocabulary)), piece_pattern())
    return _TOKENIZERS[vocabulary]


def tokens(vocabulary: str = VOCABULARY) -> list[bytes]:
    """The bytes of every id: all that decoding needs."""
    if vocabulary not in _TOKENS:
        ranks = read_ranks(vocabulary_path(vocabulary))
        _TOKENS[vocabulary] = sorted(ranks, key=ranks.get)
    return _TOKENS[vocabulary]


def _without(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c.lower() != name.lower()])


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text.  ``vocabulary``: a name known to the tokenizer package,
    opened on each executor."""
    docs = _without(docs, ids_col)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(vocabulary).encode_texts
        for batch in batches:
            column = batch.column(names.index(text_col))
            _, offsets = textops.utf8(column)
            for i, j in textops.chunks(offsets, CHUNK_BYTES):
                ends, ids = ids_of(column.slice(i, j - i).to_pylist())
                encoded = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, encoded], [*names, ids_col])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for."""
    encoded = _without(encoded, bytes_col)
    names = encoded.columns
    schema = T.StructType([*encoded.schema.fields, T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = tokens(vocabulary).__getitem__
        for batch in batches:
            column = batch.column(names.index(ids_col))
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
            if len(flat) and flat.min() < 0:
                raise IndexError(f"no token has the id {flat.min()}")
            valid = column.is_valid().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b"".join(map(bytes_of, flat[ends[r]:ends[r + 1]].tolist())) if ok else None
                                           for r, ok in enumerate(valid)], pa.binary())], [*names, bytes_col])

    return encoded.mapInArrow(run, schema)


def report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    there_and_back = decode(encode(docs.select("doc_id", "text"), vocabulary).select("doc_id", "ids"), vocabulary)
    return there_and_back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
