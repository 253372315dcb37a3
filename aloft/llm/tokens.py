"""Exact token counts of every prefix by dynamic programming over a BPE vocabulary.

A byte-fallback BPE model (a sentencepiece ``.model``) merges the best-scored
adjacent pair until none is left.  Whether two tokens can stand side by side in
a result depends on those two alone, so each prefix of a text has exactly one
last token: the one that is compatible with the last token of the prefix before
it.  With ``last[p]`` known for shorter prefixes,

    count[p] = count[p - len(token)] + 1

is the exact number of tokens of the text's first p characters.  The counts of
all prefixes answer truncation and budget questions (how many characters fit
into n tokens, how many tokens a cut costs) without encoding again.

No token spans a space mark behind another character or a character outside
all pieces, so a text splits into chunks whose counts add up; a task keeps the
counts of chunks it has seen in a bounded memory.

A null or empty text has no tokens.  Strings that look like special tokens are
ordinary text; no begin or end token is added; nothing is cut off.  Repeated
rows are counted alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"
END = ""
BOUNDARY = (1 << 30) - 1
#: entries of one generation of a task's memories; two generations are kept
CHUNK_MEMORY = 500_000
PAIR_MEMORY = 1_000_000
#: a chunk longer than this is counted, but not remembered
LONGEST_REMEMBERED = 64


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class PrefixCounter:
    """Counts of all prefixes for one model."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.score: dict[str, float] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                self.score[sp.id_to_piece(i)] = sp.get_score(i)
        if any(SPACE in p.lstrip(SPACE) or (p[0] == SPACE and p[1:2] == SPACE and p.strip(SPACE))
               for p in self.score):
            raise ValueError(f"{model_file}: pieces cross spaces; chunks would not add up")
        self.pieces = list(self.score)
        #: pieces by their characters: nested dicts, a piece's number under END
        self.trie: dict = {}
        for i, p in enumerate(self.pieces):
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[END] = i
        newline = "" if any("\n" in p for p in self.score) else "\n"
        # a run of space marks with what follows, up to the next space mark (or line end)
        self.split = re.compile(f"{SPACE}*[^{SPACE}{newline}]+|{SPACE}+" + ("|\n" if newline else "")).findall
        #: (token before or BOUNDARY, token) as one number -> whether they can stand side by side
        self.pairs: dict[int, bool] = {}
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def merge(self, text: str) -> list[str]:
        """Plain BPE on a short string: best score first, the leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, pair: int) -> bool:
        """Whether a token can follow another (or a boundary) in a result."""
        a, b = pair >> 32, self.pieces[pair & 0xFFFFFFFF]
        if len(self.pairs) >= PAIR_MEMORY:
            self.pairs.clear()
        parts = [b] if a == BOUNDARY else [self.pieces[a], b]
        ok = self.pairs[pair] = self.merge("".join(parts)) == parts
        return ok

    def prefixes(self, chunk: str) -> list[int]:
        """count[p] for p = 0 .. len(chunk) of one chunk."""
        n, trie, known = len(chunk), self.trie, self.pairs.get
        count = [0] * (n + 1)
        last = [-1] * (n + 1)  # -1: not found yet
        last[0] = BOUNDARY
        for q in range(n):
            before, node, p = last[q] << 32, trie, q
            if chunk[q] not in trie:  # a character of no piece: its bytes are tokens, nothing merges
                last[q + 1] = BOUNDARY
                count[q + 1] = count[q] + len(chunk[q].encode("utf-8", "surrogatepass"))
                continue
            while p < n:
                node = node.get(chunk[p])
                if node is None:
                    break
                p += 1
                t = node.get(END)
                if t is not None and last[p] < 0:
                    ok = known(before | t)
                    if ok is None:
                        ok = self.compatible(before | t)
                    if ok:
                        last[p] = t
                        count[p] = count[q] + 1
        return count

    def chunks(self, text: str) -> list[str]:
        return self.split(SPACE + text.replace(" ", SPACE)) if text else []

    def chunk_count(self, chunk: str) -> int:
        n = self.old.get(chunk)
        if n is None:
            n = self.prefixes(chunk)[-1]
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self.young) >= CHUNK_MEMORY:
                self.old, self.young = self.young, {}
            self.young[chunk] = n
        return n

    def chunk_counts(self, parts: list[str]) -> list[int]:
        known = self.young.get
        counts = list(map(known, parts))
        if None in counts:
            counts = [self.chunk_count(c) if n is None else n for c, n in zip(parts, counts)]
        return counts

    def count(self, text: str | None) -> int:
        return sum(self.chunk_counts(self.chunks(text))) if text else 0

    def all_prefixes(self, text: str | None) -> np.ndarray:
        """Tokens of text[:p] for p = 0 .. len(text)."""
        out = [0]
        if text:
            base = 0
            for chunk in self.chunks(text):
                c = self.prefixes(chunk)
                out.extend(base + x for x in c[1:])
                base += c[-1]
            del out[1]  # the space mark put before the text; the empty prefix has no token
        return np.array(out, dtype=np.int64)

    def fitting(self, text: str | None, limit: int) -> tuple[int, int]:
        """(tokens of the whole text, characters of its longest prefix of at most ``limit`` tokens)."""
        if not text:
            return 0, 0
        parts = self.chunks(text)
        sums = np.cumsum(self.chunk_counts(parts))
        if sums[-1] <= limit:
            return int(sums[-1]), len(text)
        k = int(np.searchsorted(sums, limit, side="right"))  # the chunk in which the limit falls
        rest = limit - (int(sums[k - 1]) if k else 0)
        inside = max(p for p, n in enumerate(self.prefixes(parts[k])) if n <= rest)
        return int(sums[-1]), max(0, sum(map(len, parts[:k])) + inside - 1)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    """One counter for each model in a worker process."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def count_tokens(docs: DataFrame, limit: int = LIMIT, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens, over_limit and limit_chars (characters of the longest
    prefix of at most ``limit`` tokens).  ``model``: a name known to the tokenizer package,
    opened on each executor."""
    docs = docs.drop("n_bytes", "n_tokens", "over_limit", "limit_chars")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()),
                           T.StructField("limit_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = counter(model_path(model)).fitting
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [fit(t, limit) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names),
                 pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                [*names, "n_tokens", "limit_chars"])

    out = docs.mapInArrow(run, schema)
    return out.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"),
        "over_limit": F.col("n_tokens") > limit})


def prefix_counts(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` with prefix_tokens: the token count of every prefix, by characters."""
    docs = docs.drop("prefix_tokens")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("prefix_tokens", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(model_path(model)).all_prefixes
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names),
                 pa.array([counts(t) for t in texts], pa.list_(pa.int64()))], [*names, "prefix_tokens"])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, limit: int = LIMIT, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, limit_chars."""
    return count_tokens(docs.select("doc_id", "text"), limit, model).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars")
