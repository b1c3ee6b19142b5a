"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass over distinct words.

White space becomes a mark, and every text falls into *marked words*: marks and what follows up to the next mark.  No
piece of a usable model continues past a mark, so a word is encoded alike wherever it stands.  Per Arrow batch the
distinct words are sorted, which lays out their trie in depth-first order: a stack holds the forward state of every
prefix of the current word, the next word keeps the states of the prefix it shares and computes the rest.

Forward states depend on the model's kind:

* *unigram*: best score of a segmentation of the prefix, and its last piece;
* *BPE*: merging gives each prefix exactly one segmentation, and the scores only rank merges, so the best total score
  would give other ids than the model's.  A piece may follow another just when merging the two together gives these two
  again (kept per pair); the state is the one last piece whose predecessor, at the prefix before it, may be followed by it.

Ids equal those of the SentencePiece library (unigram: up to segmentations of equal score).  The model file is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.llm import textops

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Text of one trie; a longer row has a trie of its own.
TRIE_BYTES = 6 << 20
_MARK = "▁"
_UNKNOWN, _START = -1, -2
# Pairs of pieces that an encoder remembers before it starts afresh.
PAIRS = 500_000


@dataclass(frozen=True)
class Model:
    """What encoding and decoding need of a model file: bounded by its vocabulary, and sent to every task."""

    bpe: bool
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]  # fixed values of the format: 1 normal, 2 unknown, 3 control, 6 byte


def load_model(path: str = MODEL) -> Model:
    """Read a model with identity normalisation, a leading mark and byte pieces; others are refused."""
    from sentencepiece import sentencepiece_model_pb2 as formats

    proto = formats.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, kinds = proto.normalizer_spec, tuple(p.type for p in proto.pieces)
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
    if not plain or not norm.escape_whitespaces or proto.trainer_spec.model_type not in (1, 2):
        raise ValueError("only unigram and BPE models with identity normalisation and a leading mark are supported")
    if kinds.count(6) != 256 or set(kinds) - {1, 2, 3, 6}:
        raise ValueError("a model has 256 byte pieces and no user-defined or unused ones")
    pieces = tuple(p.piece for p in proto.pieces)
    if any(k == 1 and _MARK in p.lstrip(_MARK) for p, k in zip(pieces, kinds)):
        raise ValueError("a piece continues past a mark")
    return Model(proto.trainer_spec.model_type == 2, pieces, tuple(p.score for p in proto.pieces), kinds)


class _Encoder:
    """Ids of sorted distinct words; marks are blanks here."""

    def __init__(self, model: Model) -> None:
        normal = {p.replace(_MARK, " "): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == 1}
        self.model, self.ids = model, normal
        self.bytes = [i for i, k in enumerate(model.kinds) if k == 6]
        self.tails: dict[str, int] = {p[i:]: _UNKNOWN for p in normal for i in range(1, len(p))}
        self.tails.update(normal)
        self.score = {p: model.scores[i] for p, i in normal.items()}
        self.text = {i: p for p, i in normal.items()}
        self.inner = {p[i : i + 2] for p in normal for i in range(len(p) - 1)}
        self.may_follow: dict[int, bool] = {}
        self.stable: dict[int, bool] = {}

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            ranked = [(self.score.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            ranked = [(-s, i) for s, i in ranked if s is not None]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _allowed(self, before: int, piece: int) -> bool:
        """Whether merging the text of both gives both again; quick when no piece reaches over where they meet."""
        parts = [self.text[i] for i in (before, piece) if i >= 0]
        if len(parts) == 2 and parts[0][-1] + parts[1][0] not in self.inner:
            return self._stable(before) and self._stable(piece)
        return self._merged("".join(parts)) == parts

    def _stable(self, piece: int) -> bool:
        if piece not in self.stable:
            self.stable[piece] = self._merged(self.text[piece]) == [self.text[piece]]
        return self.stable[piece]

    def _bpe(self, words: list[str]) -> Iterator[list[int]]:
        get, follow, width = self.tails.get, self.may_follow, len(self.model.pieces)
        last, size, previous = [_START], [0], ""
        for word in words:
            depth, shared = 0, min(len(previous), len(word))
            while depth < shared and previous[depth] == word[depth]:
                depth += 1
            del last[depth + 1 :], size[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                start, found = end - 1, []
                piece = get(word[start:end])
                while piece is not None:
                    if piece >= 0:
                        found.append((piece, start))
                    start -= 1
                    piece = get(word[start:end]) if start >= 0 else None
                while found:
                    piece, start = found.pop()
                    key = last[start] * width + piece
                    ok = follow.get(key)
                    if ok is None:
                        if len(follow) >= PAIRS:
                            follow.clear()
                        ok = follow[key] = self._allowed(last[start], piece)
                    if ok:
                        last.append(piece)
                        size.append(end - start)
                        break
                else:
                    last.append(_UNKNOWN)
                    size.append(1)
            previous = word
            yield self._path(word, last, size)

    def _unigram(self, words: list[str]) -> Iterator[list[int]]:
        tails, scores = self.tails, self.model.scores
        worst = min(self.score.values()) - 10.0
        last, size, best, previous = [_START], [0], [0.0], ""
        for word in words:
            depth = len(commonprefix((previous, word)))
            del last[depth + 1 :], size[depth + 1 :], best[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                top, chosen, start = None, (_UNKNOWN, 1), end - 1
                while start >= 0 and (piece := tails.get(word[start:end])) is not None:
                    if piece >= 0:
                        total = best[start] + scores[piece]
                        if top is None or total >= top:
                            top, chosen = total, (piece, end - start)
                    start -= 1
                if word[end - 1] not in self.ids and (top is None or best[end - 1] + worst > top):
                    top, chosen = best[end - 1] + worst, (_UNKNOWN, 1)
                best.append(top)
                last.append(chosen[0])
                size.append(chosen[1])
            previous = word
            yield self._path(word, last, size)

    def _path(self, word: str, last: list[int], size: list[int]) -> list[int]:
        out, at = [], len(word)
        while at:
            piece = last[at]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in reversed(word[at - 1].encode()))
            at -= size[at]
        out.reverse()
        return out

    def encode(self, words: list[str]) -> Iterator[list[int]]:
        return self._bpe(words) if self.model.bpe else self._unigram(words)


@lru_cache(1)
def _encoder(model: Model) -> _Encoder:
    """One encoder per Python worker: what it knows of pairs serves all tasks of the worker."""
    return _Encoder(model)


def _marked_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All marked words in a row (marks as blanks), and the number of each text; null and empty texts have none."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), _MARK, " ")
    filled = pc.not_equal(texts, "")
    texts = pc.if_else(filled, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())), texts)
    data, offsets = textops.utf8(texts)
    blank = data == 0x20
    starts = blank.copy()
    starts[1:] &= ~blank[:-1]
    starts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    at = np.flatnonzero(starts)
    counts = np.diff(np.searchsorted(at, offsets))
    ends = pa.py_buffer(np.append(at, len(data)).astype(np.int64))
    return pa.LargeStringArray.from_buffers(len(at), ends, pa.py_buffer(data)), counts


def _gather(at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of ``counts[i]`` consecutive elements from ``at[i]`` on, for all i in turn."""
    total = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(total[-1]) + np.repeat(at - total[:-1], counts)


def _bytes_of_pieces(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes that each id stands for, all in a row, where each id's begin and how many they are."""
    raw = []
    for p, k in zip(model.pieces, model.kinds):
        plain = bytes([int(p[3:5], 16)]) if k == 6 else p.replace(_MARK, " ").encode()
        raw.append({3: b"", 2: " ⁇ ".encode()}.get(k, plain))
    sizes = np.array([len(r) for r in raw], np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum(sizes)]), sizes


def _encoded(model: Model, check: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        data, at, width = _bytes_of_pieces(model)
        for batch in batches:
            for part in textops.slices(batch, "_text", TRIE_BYTES):
                words, counts = _marked_words(part.column("_text"))
                coded = words.dictionary_encode()
                order = pc.sort_indices(coded.dictionary)
                flat, sizes = [], np.zeros(len(order), np.int64)
                for i, ids in enumerate(encoder.encode(coded.dictionary.take(order).to_pylist())):
                    flat += ids
                    sizes[i] = len(ids)
                flat = np.array(flat, np.int32)
                place = np.empty(len(order), np.int64)
                place[order.to_numpy()] = np.arange(len(order))
                word = place[coded.indices.to_numpy()]
                begins = np.concatenate([[0], np.cumsum(sizes)])
                # A slice of the rows at a time, as its ids are gathered through several arrays.
                done, first = 0, np.concatenate([[0], np.cumsum(counts)])
                while done < part.num_rows:
                    upto = max(int(np.searchsorted(first, first[done] + 200_000, "right")) - 1, done + 1)
                    own = word[first[done] : first[upto]]
                    ids = flat[_gather(begins[own], sizes[own])]
                    ends = np.concatenate([[0], np.cumsum(sizes[own])])[first[done : upto + 1] - first[done]]
                    rows = part.slice(done, upto - done)
                    arrays = [c for n, c in zip(rows.schema.names, rows.columns) if n != "_text"]
                    names = [n for n in rows.schema.names if n != "_text"]
                    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                    empty = pa.array(np.diff(ends) == 0)
                    lists = pc.if_else(pc.and_(empty, rows.column("_text").is_null()), pa.scalar(None, lists.type), lists)
                    if check:
                        blob, before = data[_gather(at[ids], width[ids])].tobytes(), np.concatenate([[0], np.cumsum(width[ids])])[ends]
                        texts = [None if t is None else t.replace(_MARK, " ").encode() for t in rows.column("_text").to_pylist()]
                        same = [t is None or t == blob[a + 1 : b] for t, a, b in zip(texts, before[:-1].tolist(), before[1:].tolist())]
                        arrays, names = [*arrays, pa.array(same, pa.bool_())], [*names, "round_trip"]
                    yield pa.RecordBatch.from_arrays([*arrays, lists], [*names, "ids"])
                    done = upto
                # Workers live on and share an executor's memory with it: give back what Arrow keeps.
                del words, coded, order, flat, word
                pa.default_memory_pool().release_unused()

    return run


def _decoded(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, begins, sizes = _bytes_of_pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = part.column("_ids")
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                out = data[_gather(begins[flat], sizes[flat])]
                ends = np.concatenate([[0], np.cumsum(sizes[flat])])[np.concatenate([[0], np.cumsum(counts)])]
                blob = out.tobytes()
                texts = [blob[a + (blob[a : a + 1] == b" ") : b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                try:
                    made = pa.array(texts, pa.binary()).cast(pa.string())
                except pa.ArrowInvalid:  # ids that do not come from a text
                    made = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
                made = pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), made)
                arrays = [c for n, c in zip(part.schema.names, part.columns) if n != "_ids"]
                names = [n for n in part.schema.names if n != "_ids"]
                yield pa.RecordBatch.from_arrays([*arrays, made], [*names, "text"])

    return run


def _schema(df: DataFrame, keep: list[str], added: str) -> str:
    return ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep], added])


def encode(
    docs: DataFrame, keep: list[str], text_column: str = "text", model: Model | None = None, check: bool = False
) -> DataFrame:
    """Columns ``keep`` and ``ids``, the piece ids of each whole text: one row per row, without a shuffle.

    A null text has null ids, an empty one no ids.  The mark's own character in a text counts as a blank.  ``check`` adds
    ``round_trip`` before them: whether the ids decode to the text again.  ``keep`` may not name either of the two.
    """
    model = model or load_model()
    named = docs.select(*keep, F.col(text_column).cast("string").alias("_text"))
    added = "round_trip boolean, ids array<int>" if check else "ids array<int>"
    return named.mapInArrow(_encoded(model, check), _schema(docs, keep, added))


def decode(rows: DataFrame, keep: list[str], ids_column: str = "ids", model: Model | None = None) -> DataFrame:
    """Columns ``keep`` and ``text``: the text of each list of ids.  Null ids give null, bytes that are no text U+FFFD; ``keep`` may not name ``text``."""
    model = model or load_model()
    named = rows.select(*keep, F.col(ids_column).alias("_ids"))
    return named.mapInArrow(_decoded(model), _schema(rows, keep, "text string"))
