"""Vector bin packing of tokenised examples into fixed-length sequences.

An example asks for tokens, segments and loss-bearing tokens at once. A sequence takes, of
the examples that still fit in all three, the one whose demand has the largest dot product
with what is left (both as shares of the limits), so that scarce kinds are spent evenly.
When nothing fits whole, the best example is cut to close the gap, if cutting is allowed.

Packing needs no shuffle: each task packs the rows of its input split through a bounded
pool, so memory is a batch of texts plus the pool. A task that runs again reads the same
split and gives the same rows. A sequence that the limit of segments or of loss-bearing tokens
ends early, and the last one of a task, becomes several whose lengths are powers of two.
"""

import base64
import re
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnmart.llm.common import arrow_map, id_type, slices, struct, text_or_empty

# Examples that wait in a task at most. More give the heuristic more choice, not other rules.
POOL = 4096
# Characters of a text that are encoded at once.
PIECE = 1 << 18

# The pattern of the vocabulary never matches from a visible character over to white space,
# so the ids of a text are those of its pieces cut there. \x1c-\x1f are white space for `re` only.
_CUT = re.compile(r"(?<=[\S\x1c-\x1f])(?=[^\S\x1c-\x1f])")


class ByteBpe:
    """Ids of a byte-level BPE vocabulary given as ranks, as bytes of little-endian uint32."""

    def __init__(self, path):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._encode = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def __call__(self, text):
        return b"".join(np.array(self._encode(piece), "<u4").tobytes() for piece in _pieces(text))


def _pieces(text):
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


class Packer:
    """Sequences of one task. ``add`` takes examples, ``closed`` gives finished sequences.

    A sequence is a list of (example, start, length); ``example`` is whatever the caller
    passed. ``limits`` are tokens, segments and loss-bearing tokens of a sequence.
    """

    def __init__(self, limits, cut=True, pool=POOL):
        self.limits, self.cut, self.pool = np.array(limits, float), cut, pool
        self.waiting, self.open, self.closed = [], [], []
        self.left = self.limits.copy()

    def add(self, example, tokens, loss_from=0):
        """An example of ``tokens`` tokens, loss-bearing from position ``loss_from`` on."""
        start = 0
        while True:
            length = self._prefix(start, tokens, loss_from, self.limits)
            if start + length == tokens and self._need(start, tokens, loss_from)[0] < self.limits[0]:
                break
            if not self.cut:
                raise ValueError(f"an example of {tokens} tokens is over the limits {self.limits}")
            whole = [(example, start, length)]
            self.closed.extend([whole] if length == self.limits[0] else _powers_of_two(whole))
            start += length
            if start == tokens:
                return
        self.waiting.append((example, start, tokens, loss_from))
        if len(self.waiting) >= self.pool:
            self._place()

    def finish(self):
        self._place()
        self._close()

    @staticmethod
    def _need(start, tokens, loss_from):
        return tokens - start, 1, tokens - max(start, loss_from) if loss_from < tokens else 0

    @staticmethod
    def _prefix(start, tokens, loss_from, left):
        """How many tokens from ``start`` on fit in ``left``."""
        if left[1] < 1:
            return 0
        unpaid = max(0, loss_from - start)
        return int(min(tokens - start, left[0], unpaid + left[2]))

    def _place(self):
        items = self.waiting
        need = np.array([self._need(*x[1:]) for x in items], float).reshape(-1, 3)
        alive = np.ones(len(items), bool)
        while alive.any():
            score = np.where(alive, (need / self.limits) @ (self.left / self.limits), -1.0)
            fits = alive & (need <= self.left).all(axis=1)
            if fits.any():
                best = int(np.argmax(np.where(fits, score, -1.0)))
                alive[best] = False
                self._take(items[best], items[best][2] - items[best][1])
                continue
            if self.cut and self.left[0] >= 1 and self.left[1] >= 1:
                best = int(np.argmax(score))
                example, start, tokens, loss_from = items[best]
                length = self._prefix(start, tokens, loss_from, self.left)
                if length:
                    self._take(items[best], length)
                    items[best] = (example, start + length, tokens, loss_from)
                    need[best] = self._need(*items[best][1:])
            self._close()
        self.waiting = []

    def _take(self, item, length):
        example, start, tokens, loss_from = item
        self.open.append((example, start, length))
        self.left -= self._need(start, start + length, loss_from)
        if self.left[0] < 1:
            self._close()

    def _close(self):
        """Ends the open sequence. One that another limit than that of tokens ended is cut to lengths without padding."""
        if self.open:
            short = self.cut and self.left[0] >= 1
            self.closed.extend(_powers_of_two(self.open) if short else [self.open])
        self.open, self.left = [], self.limits.copy()


def _powers_of_two(pieces):
    """The pieces of an unfilled sequence as sequences whose lengths are powers of two.

    Such lengths need no padding; there are at most log2 of the limit.
    """
    total, out, room = sum(p[2] for p in pieces), [], 0
    for example, start, length in pieces:
        while length:
            if not room:
                room = 1 << (total.bit_length() - 1)
                out.append([])
            take = min(room, length)
            out[-1].append((example, start, take))
            start, length, room, total = start + take, length - take, room - take, total - take
    return out


def pack(
    df: DataFrame,
    ranks_path: str,
    id_col="doc_id",
    text_col="text",
    prompt_col=None,
    max_tokens=2048,
    max_segments=128,
    max_loss_tokens=None,
    end_id=1,
    cut=True,
) -> DataFrame:
    """Every example of ``df`` in sequences of at most ``max_tokens`` tokens, one row per piece.

    ``prompt_col`` names a text before ``text_col`` that bears no loss (instruction data).
    Without ``max_segments`` or ``max_loss_tokens`` only tokens limit a sequence.
    Rows: the id, ``start`` and ``length`` in the example, ``ids_crc32`` of its ids,
    ``doc_tokens``, ``loss_tokens`` of the piece, ``sequence_id`` and ``offset`` there.

    NULL texts are empty: the example is the end id alone. NULL and repeated ids and repeated
    rows are packed like any other, each row for itself. Long texts become full sequences and
    a rest. An empty table gives no rows. Other columns are not read.
    """
    limits = (max_tokens, max_segments or max_tokens, max_loss_tokens or max_tokens)
    schema = struct(
        **{id_col: id_type(df, id_col)},
        start=T.LongType(), length=T.LongType(), ids_crc32=T.LongType(), doc_tokens=T.LongType(),
        loss_tokens=T.LongType(), sequence_id=T.LongType(), offset=T.LongType(),
    )
    end = np.array([end_id], "<u4").tobytes()

    def task(batches):
        encode, packer = ByteBpe(ranks_path), Packer(limits, cut)
        sequence = TaskContext.get().partitionId() << 32

        def rows():
            nonlocal sequence
            out = [[] for _ in schema.names]
            for pieces in packer.closed:
                offset = 0
                for (key, ids, loss_from), start, length in pieces:
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    loss = max(0, start + length - max(start, loss_from))
                    row = (key, start, length, crc, len(ids) // 4, loss, sequence, offset)
                    for column, value in zip(out, row):
                        column.append(value)
                    offset += length
                sequence += 1
            packer.closed = []
            return out

        for batch in batches:
            for keys, texts, *prompts in slices(batch, 256):
                for n, (key, text) in enumerate(zip(keys, texts)):
                    prompt = encode(prompts[0][n]) if prompts else b""
                    ids = prompt + encode(text) + end
                    packer.add((key, ids, len(prompt) // 4), len(ids) // 4, len(prompt) // 4)
                yield rows()
        packer.finish()
        yield rows()

    prompts = [text_or_empty(prompt_col).alias("prompt")] if prompt_col else []
    return arrow_map(df.select(id_col, text_or_empty(text_col).alias("text"), *prompts), schema, task)
