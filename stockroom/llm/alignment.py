"""Alignment of two tokenizers' tokens by the bytes they cover, and how usual each link is in the corpus.

The tokens of a text by tokenizer A and by tokenizer B are incidence matrices of tokens and bytes, in compressed sparse rows.
The product A Bᵀ, row by row as Gustavson does it, has an entry for every two tokens that share bytes: a link. Byte offsets at
which tokens of both end cut the tokens into groups; the product of the matrices of tokens and groups links all tokens of a
group.

No token of either tokenizer reaches over a single space between two visible characters. So texts are cut there; a block of
texts lists its distinct parts, and each is encoded, aligned and multiplied once. A block then sends its distinct id pairs,
with the number of its documents that have them linked, to the bucket of the A id. A bucket sums them up, finds the most
usual pairs of each A id, and answers the blocks, which add up what their documents need.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.registry import stored
from stockroom.llm.sparse import Csr, intervals, membership, product, product_sizes

_HIDDEN = regex.compile(r"[\p{Z}\p{C}]")
#: A cut between two characters that no one takes for white space.
_BETWEEN = regex.compile(r"(?<=[^\p{Z}\p{C}]) (?=[^\p{Z}\p{C}])")
#: What stands for a space in the pieces of tokenizer B.
PIECE_SPACE = "▁"
#: Parts that are aligned at once, or characters, if they are long.
PARTS_AT_ONCE = 50_000
CHARACTERS_AT_ONCE = 1_000_000
#: Characters whose classes no version of Unicode disputes, none of them white space.
_PLAIN = regex.compile("[!-~\u00A1-\u024F]+")
#: How byte-level tokenizers cut such texts (fixed value).
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"


class Definitions(NamedTuple):
    """Tokenizer A: the JSON definition of a byte-level BPE. Tokenizer B: the bytes of a SentencePiece model that puts a
    space before the text."""

    a: str
    b: bytes


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable bytes of Latin-1 stand for themselves, the others for 256 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in own]
    return {chr(byte): byte for byte in own} | {chr(256 + at): byte for at, byte in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, definitions: Definitions):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        described = json.loads(definitions.a)
        cut = described["pre_tokenizer"]
        if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or described["normalizer"]:
            raise ValueError("tokenizer A has to be a byte-level BPE without a normalizer")
        self._a = Tokenizer.from_str(definitions.a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=definitions.b)
        letters = byte_of_letter()
        a_bytes = [b""] * self._a.get_vocab_size()
        for token, number in self._a.get_vocab().items():
            known = all(letter in letters for letter in token)
            a_bytes[number] = bytes(map(letters.__getitem__, token)) if known else token.encode()
        pieces = [self._b.id_to_piece(number) for number in range(self._b.get_piece_size())]
        if any(PIECE_SPACE in piece.lstrip(PIECE_SPACE) for piece in pieces):
            raise ValueError("tokenizer B has pieces that reach over a space")
        b_bytes = [
            bytes([int(piece[1:-1], 16)]) if self._b.is_byte(number) else piece.replace(PIECE_SPACE, " ").encode()
            for number, piece in enumerate(pieces)
        ]
        self.a_table, self.b_table = ByteTable(a_bytes), ByteTable(b_bytes)
        self._plain_a = self._fast_a(described)

    def _fast_a(self, described: dict):
        """Tokenizer A on plain texts, by ranks: if its ids are the order of its merges, ranks say the same."""
        import tiktoken

        model = described["model"]
        first = len(self.a_table) - len(model["merges"]) - len(described["added_tokens"])
        pairs = ("".join(merge if isinstance(merge, list) else merge.split(" ")) for merge in model["merges"])
        if any(model["vocab"][pair] != first + at for at, pair in enumerate(pairs)):
            return None
        letters = byte_of_letter()
        special = {token["content"] for token in described["added_tokens"]}
        ranks = {
            bytes(map(letters.__getitem__, token)): number
            for token, number in model["vocab"].items()
            if token not in special
        }
        return tiktoken.Encoding("a", pat_str=PLAIN_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of a space and each text by A, and of each text by B, which adds the space; and where each text's begin.

        A encodes plain texts in one go, with a space before each; they are cut again where a token begins with a space.
        """
        plain = np.fromiter((_PLAIN.fullmatch(text) is not None for text in texts), bool, len(texts))
        if self._plain_a is None:
            plain[:] = False
        joined = "".join([" " + text for text, good in zip(texts, plain.tolist(), strict=True) if good])
        others = [text for text, good in zip(texts, plain.tolist(), strict=True) if not good]
        a_lists = [one.ids for one in self._a.encode_batch([" " + text for text in others], add_special_tokens=False)]
        a_plain = np.array(self._plain_a(joined) if joined else [], np.int64)
        b_lists = self._b.encode(texts, num_threads=1) if texts else []
        return [
            self.a_table.in_order(a_plain, a_lists, plain),
            self.b_table.in_order(np.empty(0, np.int64), b_lists, np.zeros(len(texts), bool)),
        ]


@lru_cache(maxsize=1)
def tokenizers_of(definitions: Definitions) -> Tokenizers:
    return Tokenizers(definitions)


class Aligned(NamedTuple):
    """Texts one after another on one axis of bytes. Texts whose tokens do not give their bytes have none."""

    whole: np.ndarray  # of each text, whether it has tokens
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    group_ends: np.ndarray
    a_starts: np.ndarray  # where each text's tokens begin, one more: the end
    b_starts: np.ndarray
    group_starts: np.ndarray
    links: Csr  # A tokens and B tokens that share bytes; how many

    def group_members(self) -> tuple[Csr, Csr]:
        """Tokens of A, and of B, and the group they are in."""
        count = len(self.group_ends)
        return (
            membership(np.searchsorted(self.group_ends, self.a_ends), count),
            membership(np.searchsorted(self.group_ends, self.b_ends), count),
        )


def align(texts: list[str], tokenizers: Tokenizers) -> Aligned:
    """The tokens of several texts and their links."""
    tables = tokenizers.a_table, tokenizers.b_table
    laid = tokenizers.encode(texts)
    expected = [b" " + text.encode() if text else b"" for text in texts]
    whole = np.array([bool(text) for text in texts], bool)
    for table, (ids, starts) in zip(tables, laid, strict=True):
        whole &= table.gives(ids, starts, expected)
    if not whole.all():
        laid = [without(ids, starts, whole) for ids, starts in laid]
    (a_ids, a_starts), (b_ids, b_starts) = laid
    a_ends, b_ends = (np.cumsum(table.lengths[ids]) for table, ids in zip(tables, (a_ids, b_ids), strict=True))
    group_ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    text_ends = np.concatenate([[0], a_ends])[a_starts]
    group_starts = np.searchsorted(group_ends, text_ends, side="right")
    links = product(intervals(a_ends), intervals(b_ends).transposed())
    return Aligned(whole, a_ids, b_ids, a_ends, b_ends, group_ends, a_starts, b_starts, group_starts, links)


class ByteTable:
    """The bytes of a tokenizer's ids."""

    def __init__(self, bytes_of: list[bytes]):
        self.lengths = np.array([len(token) for token in bytes_of], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(bytes_of), np.uint8)

    def __len__(self) -> int:
        return len(self.lengths)

    def in_order(
        self, joined: np.ndarray, lists: list[list[int]], is_joined: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's begin; of some there are lists, the ids of the
        others are joined, and begin with the tokens that begin with a space."""
        firsts = np.flatnonzero((self.data[self.starts[joined]] == 32) & (self.lengths[joined] > 0))
        counts = np.empty(len(is_joined), np.int64)
        counts[is_joined] = np.diff(firsts, append=len(joined))
        counts[~is_joined] = np.fromiter(map(len, lists), np.int64, len(lists))
        starts = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(int(starts[-1]), np.int64)
        from_joined = np.repeat(is_joined, counts)
        ids[from_joined] = joined
        ids[~from_joined] = np.fromiter(chain.from_iterable(lists), np.int64, len(ids) - len(joined))
        return ids, starts

    def gives(self, ids: np.ndarray, starts: np.ndarray, expected: list[bytes]) -> np.ndarray:
        """Of each list whether its bytes are the expected ones."""
        lengths = self.lengths[ids]
        sizes = np.fromiter(map(len, expected), np.int64, len(expected))
        good = _sums(lengths, starts) == sizes
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        made = self.data[np.repeat(self.starts[ids], lengths) + within]
        if good.all():
            wrong = np.flatnonzero(made != np.frombuffer(b"".join(expected), np.uint8))
            good[np.searchsorted(np.cumsum(sizes), wrong, side="right")] = False
            return good
        edges = np.concatenate([[0], np.cumsum(lengths)])[starts].tolist()
        same = [made[a:b].tobytes() == text for a, b, text in zip(edges[:-1], edges[1:], expected, strict=True)]
        return np.array(same, bool)


def without(ids: np.ndarray, starts: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts that are not kept go."""
    counts = np.diff(starts)
    return ids[np.repeat(kept, counts)], np.concatenate([[0], np.cumsum(np.where(kept, counts, 0))])


class GroupWriter:
    """Groups as text: ids of A, a bar, ids of B; groups end with a semicolon."""

    def __init__(self, tokenizers: Tokenizers):
        self.a_count, self.b_count = len(tokenizers.a_table), len(tokenizers.b_table)
        counts = [(self.a_count, b","), (self.a_count, b"|"), (self.b_count, b","), (self.b_count, b";")]
        self.written = [b"%d%b" % (number, mark) for count, mark in counts for number in range(count)]

    def write(self, aligned: Aligned) -> list[bytes]:
        """One text's groups each, all of them with their semicolon."""
        a_groups, b_groups = (members.indices for members in aligned.group_members())
        count = len(aligned.group_ends)
        a_last, b_last = (np.diff(groups, append=count) > 0 for groups in (a_groups, b_groups))
        codes = np.empty(len(a_groups) + len(b_groups), np.int64)
        # An A token stands behind the B tokens of earlier groups, a B token behind the A tokens of its own, too.
        b_before = np.searchsorted(b_groups, a_groups, side="left")
        a_before = np.searchsorted(a_groups, b_groups, side="right")
        codes[np.arange(len(a_groups)) + b_before] = aligned.a_ids + self.a_count * a_last
        codes[np.arange(len(b_groups)) + a_before] = 2 * self.a_count + aligned.b_ids + self.b_count * b_last
        written = list(map(self.written.__getitem__, codes.tolist()))
        edges = (aligned.a_starts + aligned.b_starts).tolist()
        return [b"".join(written[start:end]) for start, end in zip(edges[:-1], edges[1:], strict=True)]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of each stretch of ``values``; stretches may be empty."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return running[starts[1:]] - running[starts[:-1]]


class _Irregular(Exception):
    """A part of a text that does not begin and end with something visible."""


class Regular(dict):
    """Numbers of parts between spaces, given as they come."""

    def __init__(self, parts: list[str]):
        self.parts = parts

    def __missing__(self, part: str) -> int:
        if not part or _HIDDEN.match(part[0]) or _HIDDEN.match(part[-1]):
            raise _Irregular
        number = self[part] = len(self.parts)
        self.parts.append(part)
        return number


class Block:
    """Distinct parts of some documents, and the documents as lists of them."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.regular = Regular(self.parts)
        #: Beginnings and ends of texts, and parts between several spaces.
        self.others: dict[str, int] = {}
        self.ids: list = []
        self.documents: list[np.ndarray] = []
        self.characters = 0

    def add(self, document: object, text: str) -> None:
        parts = text.split(" ") if text else []
        try:
            found = np.fromiter(map(self.regular.__getitem__, parts), np.uint32, len(parts))
        except _Irregular:
            found = np.array([self.number(part) for part in _BETWEEN.split(text)], np.uint32)
        self.ids.append(document)
        self.documents.append(found)
        self.characters += len(text)

    def number(self, part: str) -> int:
        try:
            return self.regular[part]
        except _Irregular:
            if part not in self.others:
                self.others[part] = len(self.parts)
                self.parts.append(part)
            return self.others[part]

    def aligned_parts(self, tokenizers: Tokenizers) -> Iterator[Aligned]:
        texts, characters = [], 0
        for part in self.parts:
            texts.append(part)
            characters += len(part)
            if len(texts) >= PARTS_AT_ONCE or characters >= CHARACTERS_AT_ONCE:
                yield align(texts, tokenizers)
                texts, characters = [], 0
        if texts:
            yield align(texts, tokenizers)

    def row(self, number: int, tokenizers: Tokenizers, writer: GroupWriter, buckets: int) -> pa.RecordBatch:
        """What the block is worth: its documents' figures, its pairs by bucket, and what the figures of pairs add up to."""
        whole, figures, written, pairs, part_links = [], [], [], [], []
        width = len(tokenizers.b_table)
        for aligned in self.aligned_parts(tokenizers):
            whole.append(aligned.whole)
            rows, columns = aligned.links.rows(), aligned.links.indices
            link_counts = _sums(np.diff(aligned.links.indptr), aligned.a_starts)
            a_groups, b_groups = aligned.group_members()
            in_groups = _sums(product_sizes(a_groups, b_groups.transposed()), aligned.a_starts)
            starts = aligned.a_starts, aligned.b_starts, aligned.group_starts
            figures.append(np.stack([*map(np.diff, starts), link_counts, in_groups]))
            written += writer.write(aligned)
            pairs.append(aligned.a_ids[rows] * width + aligned.b_ids[columns])
            part_links.append(link_counts)
        whole = np.concatenate([*whole, np.empty(0, bool)])
        figures = np.concatenate([np.empty((5, 0), np.int64), *figures], axis=1)
        link_starts = np.concatenate([[0], *part_links]).cumsum()
        keys, pair_of_link = np.unique(np.concatenate([np.empty(0, np.int64), *pairs]), return_inverse=True)
        # By bucket, so that the answers are in the order of the pairs.
        bucket = bucket_of(keys // width, buckets)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        keys, bucket, pair_of_link = keys[order], bucket[order], rank[pair_of_link]

        lengths = np.array([len(document) for document in self.documents])
        places = np.concatenate([np.empty(0, np.uint32), *self.documents])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        valid = lengths > 0
        valid[owner[~whole[places]]] = False
        places, owner = places[valid[owner]], owner[valid[owner]]
        lengths = np.where(valid, lengths, 0)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        totals = [_sums(figure[places], starts) for figure in figures]
        digests = []
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            groups = b"".join(map(written.__getitem__, places[start:end].tolist()))
            digests.append(hashlib.sha256(groups[:-1]).hexdigest() if groups else "")
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        documents_with = _documents_with(owner, places, link_starts, pair_of_link, len(keys), len(whole))
        lists = [
            {"bucket": at, "n": high - low, "keys": squeezed(keys[low:high]), "documents": squeezed(documents_with[low:high])}
            for at, (low, high) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            if high > low
        ]
        list_type = pa.list_(
            pa.struct([("bucket", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("documents", pa.binary())])
        )
        columns = {
            "block": pa.array([number], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(pa.int64())),
            "figures": pa.array([[total.tolist() for total in totals]], pa.list_(pa.list_(pa.int64()))),
            "digests": pa.array([digests], pa.list_(pa.string())),
            "lengths": pa.array([squeezed(lengths)], pa.binary()),
            "places": pa.array([squeezed(places)], pa.binary()),
            "part_links": pa.array([squeezed(np.diff(link_starts))], pa.binary()),
            "link_pairs": pa.array([squeezed(pair_of_link)], pa.binary()),
            "lists": pa.array([lists], list_type),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


BLOCKS = (
    "block long, ids array<long>, figures array<array<long>>, digests array<string>, lengths binary, places binary, "
    "part_links binary, link_pairs binary, lists array<struct<bucket:int,n:int,keys:binary,documents:binary>>"
)


def bucket_of(a_ids: np.ndarray, buckets: int) -> np.ndarray:
    """All pairs of an A id are in one bucket."""
    mixed = (a_ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (mixed % np.uint64(buckets)).astype(np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, in order."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]]


def _documents_with(
    owner: np.ndarray, places: np.ndarray, link_starts: np.ndarray, pair_of_link: np.ndarray, pairs: int, parts: int
) -> np.ndarray:
    """Of each pair, how many of a block's documents have it linked."""
    counts = np.zeros(pairs, np.int64)
    met = distinct(owner * max(1, parts) + places)
    owner, places = met // max(1, parts), met % max(1, parts)
    sizes = np.diff(link_starts)[places]
    # Some documents at a time, as each of their links needs several numbers.
    running = np.cumsum(sizes)
    start = 0
    while start < len(met):
        end = int(np.searchsorted(running, (running[start - 1] if start else 0) + 4_000_000, side="right"))
        end = max(end, start + 1)
        while end < len(met) and owner[end] == owner[end - 1]:
            end += 1
        lengths = sizes[start:end]
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        linked = pair_of_link[np.repeat(link_starts[places[start:end]], lengths) + within]
        seen = distinct(np.repeat(owner[start:end], lengths) * max(1, pairs) + linked)
        counts += np.bincount(seen % max(1, pairs), minlength=pairs)
        start = end
    return counts


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes: how many, their width, and all first bytes, all second ones and so on, compressed."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T).tobytes()
    head = np.array([len(values), width], np.int64).tobytes()
    return head + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unsqueezed(data: bytes, kind: type) -> np.ndarray:
    count, width = np.frombuffer(data, np.int64, 2).tolist()
    if not count:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data[16:], count * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, count).T).view(kind).reshape(count)


def blocker(definitions: Definitions, characters: int, buckets: int) -> Callable:
    """For mapInArrow: documents to blocks of about so many characters."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = tokenizers_of(definitions)
        writer = GroupWriter(tokenizers)
        block, number = Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for document, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(document, text.as_py())
                if block.characters >= characters:
                    yield block.row(number, tokenizers, writer, buckets)
                    block, number = Block(), number + 1
        if block.ids:
            yield block.row(number, tokenizers, writer, buckets)

    return blocks


def summer() -> Callable:
    """For mapInArrow over lists sorted by bucket: each bucket's pairs and the number of documents that have them."""

    def row(bucket: int, sums: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([bucket], pa.int32()),
                pa.array([squeezed(sums[0])], pa.binary()),
                pa.array([squeezed(sums[1])], pa.binary()),
            ],
            names=["bucket", "keys", "documents"],
        )

    def merged(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([keys for keys, _ in lists]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, np.concatenate([counts for _, counts in lists]))
        return keys, sums

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, lists, held = None, [], 0
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("bucket", "keys", "documents"))
            for at, keys, counts in zip(*columns, strict=True):
                if at != bucket and lists:
                    yield row(bucket, merged(lists))
                    lists, held = [], 0
                bucket = at
                lists.append((unsqueezed(keys, np.int64), unsqueezed(counts, np.int64)))
                held += len(lists[-1][0])
                # What repeats goes, so a bucket needs no more than twice its distinct pairs.
                if held > max(1_000_000, 2 * len(lists[0][0])):
                    lists = [merged(lists)]
                    held = len(lists[0][0])
        if lists:
            yield row(bucket, merged(lists))

    return sums


def answerer(width: int) -> Callable:
    """For mapInArrow over each bucket's sums and then its lists: of each list's pairs the sum, and whether the A id has
    no pair with a higher one."""

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sums = best = np.empty(0, np.int64)
        for batch in batches:
            found = {"block": [], "bucket": [], "sums": [], "best": []}
            columns = (batch.column(name).to_pylist() for name in ("bucket", "block", "keys", "documents"))
            for bucket, block, listed, counts in zip(*columns, strict=True):
                if block is None:
                    keys, sums = unsqueezed(listed, np.int64), unsqueezed(counts, np.int64)
                    starts = np.flatnonzero(np.diff(keys // width, prepend=-1))
                    highest = np.repeat(np.maximum.reduceat(sums, starts), np.diff(np.append(starts, len(keys))))
                    best = sums == highest
                    continue
                at = np.searchsorted(keys, unsqueezed(listed, np.int64))
                found["block"].append(block), found["bucket"].append(bucket)
                found["sums"].append(squeezed(sums[at])), found["best"].append(squeezed(best[at]))
            kinds = pa.int64(), pa.int32(), pa.binary(), pa.binary()
            arrays = [pa.array(values, kind) for values, kind in zip(found.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(found))

    return answers


DOCUMENTS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def finisher() -> Callable:
    """For mapInArrow: blocks with the answers they got to the figures of their documents."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                entries = sorted(row["answers"] or [], key=lambda entry: entry["bucket"])
                sums = np.concatenate([np.empty(0, np.int64), *[unsqueezed(x["sums"], np.int64) for x in entries]])
                best = np.concatenate([np.empty(0, bool), *[unsqueezed(x["best"], np.bool_) for x in entries]])
                links = unsqueezed(row["link_pairs"], np.uint32)
                link_starts = np.concatenate([[0], np.cumsum(unsqueezed(row["part_links"], np.int64))])
                places = unsqueezed(row["places"], np.uint32)
                starts = np.concatenate([[0], np.cumsum(unsqueezed(row["lengths"], np.int64))])
                added = [_sums(_sums(values[links], link_starts)[places], starts) for values in (best, sums)]
                columns = [pa.array(row["ids"], pa.int64())]
                columns += [pa.array(values, pa.int64()) for values in (*row["figures"], *added)]
                columns.append(pa.array(row["digests"], pa.string()))
                names = [column.split()[0] for column in DOCUMENTS.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return finish


def alignment_figures(
    documents: DataFrame,
    definitions: Definitions,
    block_characters: int = 16_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: its tokens by A and by B, groups, links, links within groups (``n_group_links``), how many links have the
    highest count of their A id (``n_best``), the counts of all links added up, and a digest of its groups. A pair's count is
    the number of documents of the whole table that have it linked.

    A encodes a space and the text, B the text, as it adds the space; strings of special tokens are plain text. A NULL or empty
    text, and one whose tokens' bytes are not the space and the text, has no tokens: zeros, and an empty string as digest.
    Rows that repeat an id are documents of their own; a NULL id is kept. An empty table gives no rows; further columns are
    ignored. A text of any length is encoded whole; one without a space is one part and needs memory in proportion.
    """
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    blocks = stored(rows.mapInArrow(blocker(definitions, block_characters, 4 * parts), BLOCKS), "aligned-blocks")
    lists = blocks.select("block", F.inline("lists"))
    by_bucket = lists.select("bucket", "keys", "documents").repartition(parts, "bucket").sortWithinPartitions("bucket")
    sums = stored(by_bucket.mapInArrow(summer(), "bucket int, keys binary, documents binary"), "pair-counts")
    asked = lists.select("bucket", "block", "keys", "documents")
    both = sums.select("bucket", F.lit(None).cast("long").alias("block"), "keys", "documents").unionByName(asked)
    width = len(tokenizers_of(definitions).b_table)
    answers = (
        both.repartition(parts, "bucket")
        .sortWithinPartitions("bucket", F.col("block").asc_nulls_first())
        .mapInArrow(answerer(width), "block long, bucket int, sums binary, best binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("bucket", "sums", "best")).alias("answers"))
    )
    # Never broadcast: the answers grow with the texts.
    return blocks.drop("lists").join(answers.hint("merge"), "block", "left").mapInArrow(finisher(), DOCUMENTS)


LINK = "struct<a:int,b:int,bytes:int>"
ALIGNED = (
    f"doc_id long, a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>, group_ends array<int>, "
    f"links array<{LINK}>"
)


def aligner(definitions: Definitions) -> Callable:
    """For mapInArrow: each document's tokens, groups and links."""

    def align_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = tokenizers_of(definitions)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                one = align([text.as_py()], tokenizers)
                ends = one.a_ids, one.a_ends, one.b_ids, one.b_ends, one.group_ends
                linked = (x.tolist() for x in (one.links.rows(), one.links.indices, one.links.values))
                links = [{"a": a, "b": b, "bytes": shared} for a, b, shared in zip(*linked, strict=True)]
                rows.append([*(x.tolist() for x in ends), links])
            link = pa.struct([(name, pa.int32()) for name in ("a", "b", "bytes")])
            kinds = [*[pa.list_(pa.int32())] * 5, pa.list_(link)]
            arrays = [pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)]
            names = ["doc_id", "a_ids", "a_ends", "b_ids", "b_ends", "group_ends", "links"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    return align_all


def aligned_tokens(
    documents: DataFrame, definitions: Definitions, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document the ids of both tokenizers and the byte offsets at which they end (in a space and the text), the ends of
    groups, and the links: places of two tokens and the bytes they share. Cases are those of :func:`alignment_figures`; a
    document without tokens has empty arrays."""
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(aligner(definitions), ALIGNED)
