"""SentencePiece encoding and decoding: distinct words in sorted order share the forward states of common prefixes."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.text import joined, ragged, slices

MARK = "▁"
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_UNKNOWN = -1
#: Bytes of text whose distinct words are encoded together, and how many answers on neighbouring pieces are kept.
_SLICE = 1 << 22
_KEPT = 1 << 18


@dataclass
class Vocabulary:
    """The pieces of a model. ``merges`` says that pieces are made by merging pairs, best score first, left first on
    ties; otherwise the path with the best sum of scores is taken."""

    ids: dict[str, int]
    score: list[float]
    spelled: list[bytes]
    byte: list[int]
    merges: bool
    time: dict[int, float] = field(default_factory=dict)
    halves: dict[int, tuple[int, int]] = field(default_factory=dict)
    tails: set[str] = field(default_factory=set)
    fits: dict[int, bool] = field(default_factory=dict)
    names: dict[int, str] = field(default_factory=dict)

    @classmethod
    def load(cls, model: bytes) -> Vocabulary:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        rules = spec.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models that keep texts as they are, with a space before the first word, are supported")
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = lib.get_piece_size()
        byte = [0] * 256
        ids, score, spelled = {}, [], []
        for i in range(size):
            piece = lib.id_to_piece(i)
            score.append(lib.get_score(i))
            if lib.is_byte(i):
                byte[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i):
                spelled.append(b"")
            else:
                ids[piece] = i
                spelled.append(piece.replace(MARK, " ").encode())
                if MARK in piece.lstrip(MARK):
                    raise ValueError("a piece crosses the start of a word")
        made = cls(ids, score, spelled, byte, spec.trainer_spec.model_type == spec.trainer_spec.BPE)
        made.names = {i: piece for piece, i in ids.items()}
        if made.merges:
            made._undo()
        made.tails = {piece[i:] for piece in made.ids for i in range(len(piece))}
        return made

    def _undo(self) -> None:
        """When each piece comes to be, and of which two; pieces that merging never makes are left out."""
        gone = []
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.time[i] = float("-inf")
                continue
            self.time[i] = -self.score[i]
            parts = list(piece)
            while len(parts) > 1:
                pairs = [(self.score[self.ids[a + b]], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ids]
                if not pairs:
                    break
                at = -max(pairs)[1]
                if len(parts) == 2 and parts[0] in self.ids and parts[1] in self.ids:
                    self.halves[i] = self.ids[parts[0]], self.ids[parts[1]]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if i not in self.halves:
                gone.append(piece)
        for piece in gone:
            del self.ids[piece]

    def follows(self, left: int, right: int) -> bool:
        """Whether two pieces can stand side by side: no merge across their border comes before they are both made.

        Going back in time, the later of the two is undone; the part at the border lived until then. A merge of the
        two neighbours across the border would have happened if it comes before that. Of equal pieces the left one is
        made first.
        """
        if left == _UNKNOWN or right == _UNKNOWN:
            return True
        until, before_tie = float("inf"), False
        while True:
            across = self.ids.get(self.names[left] + self.names[right])
            if across is not None and (self.time[across] < until or (before_tie and self.time[across] == until)):
                return False
            if left not in self.halves and right not in self.halves:
                return True
            if self.time[left] > self.time[right]:
                until, before_tie = self.time[left], False
                left = self.halves[left][1]
            else:
                until, before_tie = self.time[right], True
                right = self.halves[right][0]


def encode_words(words: list[str], model: Vocabulary) -> list[list[int]]:
    """Ids of each word. ``words`` must be sorted: neighbours then walk a trie depth first, and a word takes over the
    forward states of the prefix it shares with the word before.

    The forward state of a prefix is its last piece, where that begins and, for score models, the sum of scores. For
    models that merge pairs the last piece of a prefix is the one that can stand after the last piece of what is left.
    """
    ids, tails, byte, score, fits, merges = model.ids, model.tails, model.byte, model.score, model.fits, model.merges
    if len(fits) > _KEPT:
        fits.clear()
    longest = max(map(len, ids), default=1)
    floor = min(score) - 10
    last, begin, best = [0], [0], [0.0]
    out, before = [], ""
    for word in words:
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del last[shared + 1 :], begin[shared + 1 :], best[shared + 1 :]
        for i in range(shared + 1, len(word) + 1):
            piece, start, sum_ = _UNKNOWN, i - 1, best[i - 1] + floor
            for j in range(i - 1, max(i - longest, 0) - 1, -1):
                part = word[j:i]
                if part not in tails:
                    break
                found = ids.get(part)
                if found is None:
                    continue
                if not merges:
                    if best[j] + score[found] > sum_ or piece == _UNKNOWN:
                        piece, start, sum_ = found, j, best[j] + score[found]
                    continue
                if j:
                    key = (last[j] << 20) + found
                    ok = fits.get(key)
                    if ok is None:
                        ok = fits[key] = model.follows(last[j], found)
                    if not ok:
                        continue
                piece, start = found, j
                break
            last.append(piece)
            begin.append(start)
            best.append(sum_)
        path, i = [], len(word)
        while i:
            if last[i] == _UNKNOWN:
                path += [byte[b] for b in reversed(word[i - 1].encode())]
            else:
                path.append(last[i])
            i = begin[i]
        path.reverse()
        out.append(path)
        before = word
    return out


def encode(column: pa.Array, model: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts one after the other, and how many each text has. Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    lists = pc.split_pattern(column, " ")
    off = lists.offsets.to_numpy()
    values = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
    off = off - off[0]
    code = values.indices.to_numpy().astype(np.int64)
    parts = values.dictionary.to_pylist()
    odd = np.array([not part or MARK in part for part in parts], bool)
    special = np.logical_or.reduceat(odd[code], off[:-1]) if len(column) else np.zeros(0, bool)
    # Texts with neighbouring spaces, spaces at an end or marks of their own are cut at marks one by one.
    more, runs = {}, []
    for i in np.flatnonzero(special).tolist():
        text = column[i].as_py()
        run = _SEGMENT.findall((MARK + text).replace(" ", MARK)) if text else []
        runs.append([len(parts) + more.setdefault(s, len(more)) for s in run])
    marked = [MARK + part for part in parts] + list(more)
    order = sorted(range(len(marked)), key=marked.__getitem__)
    coded: list[list[int]] = [[]] * len(marked)
    for i, path in zip(order, encode_words([marked[i] for i in order], model), strict=True):
        coded[i] = path
    length = np.array([len(c) for c in coded], np.int64)
    flat = np.fromiter((i for c in coded for i in c), np.int32, int(length.sum()))
    start = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(column)), np.diff(off))
    plain = ~special[owner]
    run = np.concatenate([code[plain], np.array([i for r in runs for i in r], np.int64)])
    who = np.concatenate([owner[plain], np.repeat(np.flatnonzero(special), [len(r) for r in runs])]).astype(np.int64)
    by_text = np.argsort(who, kind="stable")
    run, who = run[by_text], who[by_text]
    count = np.bincount(who, length[run], len(column)).astype(np.int64)
    return flat[ragged(start[run], length[run])], count


def decode(ids: np.ndarray, count: np.ndarray, model: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts one after the other, and how many each text has."""
    size = np.array([len(s) for s in model.spelled], np.int64)
    data = np.frombuffer(b"".join(model.spelled), np.uint8)
    start = np.cumsum(size) - size
    out = data[ragged(start[ids], size[ids])]
    owner = np.repeat(np.arange(len(count)), count)
    many = np.bincount(owner, size[ids], len(count)).astype(np.int64)
    some = many > 0
    keep = np.ones(len(out), bool)
    keep[(np.cumsum(many) - many)[some]] = False  # the space before the first word
    return out[keep], many - some


def _strings(data: np.ndarray, count: np.ndarray) -> pa.Array:
    off = np.append(0, np.cumsum(count)).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_string(), len(count), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])
    return array.cast(pa.string())


def tokenise(docs: DataFrame, model: bytes) -> DataFrame:
    """All columns of ``docs``, with ``ids``, the pieces of each text, ``n_pieces``, and ``text`` as decoded from them.

    Words are found per task: each distinct word of a batch is encoded once, in sorted order. Null and empty texts have
    no pieces and decode to the empty text. A text decodes to itself unless it holds the mark of a word's start, which
    decodes to a space. Columns ``ids`` and ``n_pieces`` are replaced.
    """
    docs = docs.drop("ids", "n_pieces")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at = names.index("text")
            for first, texts in slices(batch.column(at), _SLICE):
                ids, count = encode(texts, shared.value)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(ids))
                columns = [c.slice(first, len(texts)) for c in batch.columns]
                columns[at] = _strings(*decode(ids, count, shared.value))
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists, pa.array(count.astype(np.int32))], names=[*names, "ids", "n_pieces"]
                )

    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{given}, ids array<int>, n_pieces int")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """``(doc_id, n_pieces, ids_crc32, text_crc32, same_text)``: the pieces of each text and the text decoded from them,
    as crc32 values (ids as little-endian 32-bit integers), and whether it is the text that was encoded."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1), _SLICE):
                ids, count = encode(texts, shared.value)
                data, size = decode(ids, count, shared.value)
                given, off = joined(texts)
                raw, text, source = (memoryview(np.ascontiguousarray(x)).cast("B") for x in (ids.astype("<u4"), data, given))
                end, stop = np.cumsum(count), np.cumsum(size)
                rows = []
                for i in range(len(texts)):
                    piece = text[stop[i] - size[i] : stop[i]]
                    rows.append((zlib.crc32(raw[4 * (end[i] - count[i]) : 4 * end[i]]), zlib.crc32(piece), piece == source[off[i] : off[i + 1]]))
                crc, text_crc, same = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(count), pa.array(crc, pa.int64()), pa.array(text_crc, pa.int64()), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "ids_crc32", "text_crc32", "same_text"],
                )

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, text_crc32 long, same_text boolean")
