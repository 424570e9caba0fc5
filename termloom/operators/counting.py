"""Counts of terms in columns instead of row by row, for terms that are mostly rare.

Most terms of several words occur once or twice, so an aggregation before the shuffle hands on
nearly as many rows as it gets, and every join that follows moves them again. Here a batch of
occurrences is counted by sorting whole numbers, and what is shuffled are the counts of
some dozens of (user, term) pairs in one row. All pairs of a term meet in one place, so the total
of the term is found with their counts and no join is needed for it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .llr import PIECE_ROWS, SHARE, attach_totals, key_totals

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# terms are dealt to so many buckets by their hash; a worker holds one bucket at least
BUCKETS = 8192
# what is counted at once by a task: bounds the memory of a worker, and numbers of n-grams to 64 bits
CHUNK_WORDS, CHUNK_BYTES, PIECES = 600_000, 64 << 20, 50
# pairs that are added up at once, and those of one task
GROUP_ROWS, TASK_ROWS = 64_000, 1_000_000
# a bucket that has more pairs than others, by this factor, holds a term that many users have
CROWDED = 4
BATCH_ROWS, BATCH_BYTES = 1 << 16, 16 << 20
# numbers of n-grams stay below this
MOST_IDS = 1 << 62
# fixed values: odd numbers that spread bits, and the blank between words as it is hashed
BASE, MIX, BLANK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(ord(" ") + 1)

# counts of the pairs of one bucket. ``users`` are places in ``emails``; terms lie end to end
PARTS = "bucket int, n long, lengths binary, terms binary, users binary, counts binary, emails array<string>"
PAIRS = "email string, term string, k long"
COUNTS = "email string, term string, k11 long, term_total long"


def _codes(column) -> tuple[np.ndarray, pa.Array]:
    """Places in the distinct values, nulls among them, and the values."""
    column = column if isinstance(column, pa.ChunkedArray) else pa.chunked_array([column])
    encoded = column.dictionary_encode(null_encoding="encode").combine_chunks()
    encoded = encoded.chunk(0) if isinstance(encoded, pa.ChunkedArray) else encoded
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1]))


def _rows_in(rows: int, taken: int, most: int, at_most: int) -> int:
    """How many of the rows, which take so many bytes, keep below a limit; one at least."""
    return max(1, min(at_most, rows * most // max(taken, 1)))


def _binary(data: pa.Buffer, offsets: np.ndarray) -> pa.Array:
    if offsets[-1] >= 1 << 31:
        raise OverflowError("terms of a thousand words take more than two gigabytes")
    offsets = np.ascontiguousarray(offsets, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), data])


def _joined(column: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Offsets of values from the first one's start, and all values end to end."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2] or pa.py_buffer(b"")
    return offsets - offsets[0], data.slice(offsets[0], offsets[-1] - offsets[0])


def _hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each word the value of its bytes as a polynomial in ``BASE``, and ``BASE`` to the number of them.

    So the value of words and blanks in a row follows from those of the words, and is the same in all processes.
    """
    offsets, data = _joined(words)
    lengths = np.diff(offsets)
    powers = np.cumprod(np.append(np.uint64(1), np.full(lengths.max(initial=0), BASE)))
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], lengths)
    signs = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * powers[place]
    values = np.zeros(len(words), np.uint64)
    values[lengths > 0] = np.add.reduceat(signs, offsets[:-1][lengths > 0]) if len(signs) else 0
    return values, powers[lengths]


def _buckets(spelled: list[np.ndarray], values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """The buckets of terms of which the places of the first, second, ... words are given."""
    value, power = values[spelled[0]], powers[spelled[0]]
    for code in spelled[1:]:
        value = value + power * (BLANK + BASE * values[code])
        power = power * BASE * powers[code]
    value ^= value >> np.uint64(29)
    return (value * MIX >> np.uint64(32)).astype(np.int64) % BUCKETS


def _grams(codes: np.ndarray, at: np.ndarray, n_words: int, n_users: int, size: int) -> Iterator[tuple[np.ndarray, int]]:
    """For n-grams of 1 to ``size`` words a number for the one that ends at each place, -1 for none, and a bound of them."""
    ids, bound = codes, n_words
    yield ids, bound
    for k in range(1, size):
        if bound * n_words * n_users >= MOST_IDS:
            found, ids = np.unique(ids, return_inverse=True)
            # the least one stands for none
            ids, bound = (ids - 1, len(found)) if found[0] < 0 else (ids, len(found))
        before = np.append(-1, ids[:-1])
        ids = np.where((before >= 0) & (codes >= 0) & (at >= k), before * n_words + codes, -1)
        bound *= n_words
        yield ids, bound


def _count_chunk(pieces: list[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of (email, context, words) that end behind the context."""
    rows = pa.Table.from_batches(pieces)
    piece_user, emails = _codes(rows["email"])
    words = pa.chunked_array([c.flatten() for c in rows["words"].chunks])
    encoded = words.dictionary_encode().combine_chunks()
    encoded = encoded.chunk(0) if isinstance(encoded, pa.ChunkedArray) else encoded
    codes, vocabulary = encoded.indices.fill_null(-1).to_numpy().astype(np.int64), encoded.dictionary.cast(pa.large_binary())
    lengths = np.concatenate([c.value_lengths().fill_null(0).to_numpy() for c in rows["words"].chunks])
    at = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ends = at >= np.repeat(rows["context"].to_numpy(), lengths)
    user = np.repeat(piece_user, lengths)
    hashes = _hashes(vocabulary)
    owners, buckets, counts, terms = [], [], [], []
    for k, (ids, bound) in enumerate(_grams(codes, at, len(vocabulary), len(emails), size)):
        places = np.flatnonzero(ends & (ids >= 0))
        key = user[places] * bound + ids[places]
        order = np.argsort(key)
        first = _starts(key[order]) if len(key) else order
        counts.append(np.diff(np.append(first, len(key))))
        places = places[order[first]]
        owners.append(user[places])
        spelled = [codes[places - back] for back in range(k, -1, -1)]
        buckets.append(_buckets(spelled, *hashes))
        spelled = [vocabulary.take(pa.array(code)) for code in spelled]
        blank = pa.scalar(b" ", pa.large_binary())
        terms.append(pc.binary_join_element_wise(*spelled, blank) if k else spelled[0])
    rest = np.concatenate(buckets) * len(emails) + np.concatenate(owners)
    if not len(rest):
        return
    order = np.argsort(rest)
    rest, counts = rest[order], np.concatenate(counts)[order]
    bucket, user = np.divmod(rest, len(emails))
    begin = _starts(bucket)
    bounds = np.append(begin, len(bucket))
    owner = _starts(rest)
    place = np.zeros(len(rest), np.int64)
    place[owner[1:]] = 1
    place = np.cumsum(place)
    offsets, data = _joined(pa.concat_arrays(terms).take(pa.array(order)))
    listed = pa.ListArray.from_arrays(
        pa.array(np.append(place[begin], len(owner)), pa.int32()), emails.take(pa.array(user[owner])).cast(pa.string())
    )
    numbers = np.diff(offsets), place - np.repeat(place[begin], np.diff(bounds)), counts
    lengths, users, counts = (_binary(pa.py_buffer(x.astype(np.int32)), 4 * bounds) for x in numbers)
    found = pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[begin], pa.int32()),
            pa.array(np.diff(bounds), pa.int64()),
            lengths,
            _binary(data, offsets[bounds]),
            users,
            counts,
            listed,
        ],
        names=["bucket", "n", "lengths", "terms", "users", "counts", "emails"],
    )
    for start in range(0, found.num_rows, 1000):
        yield found.slice(start, 1000)


def _count_parts(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Counts of pieces of texts, chunk by chunk."""
    # terms of more words take more bytes
    most_words, most_bytes = 3 * CHUNK_WORDS // max(size, 3), CHUNK_BYTES // size
    held, words, taken = [], 0, 0
    for batch in batches:
        step = _rows_in(batch.num_rows, _joined(batch.column("words").flatten())[1].size, most_bytes, PIECES)
        for start in range(0, batch.num_rows, step):
            some = batch.slice(start, step)
            held.append(some)
            values = some.column("words").flatten()
            words += len(values) + some.num_rows
            taken += _joined(values)[1].size
            if words >= most_words or taken >= most_bytes:
                yield from _count_chunk(held, size)
                held, words, taken = [], 0, 0
    if held:
        yield from _count_chunk(held, size)


def _pairs(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """The pairs of parts: places of users, emails by place, terms, counts."""
    users, emails, n_emails, lengths, data, counts = [], [], 0, [], [], []
    for part in parts:
        listed = part.column("emails")
        begins = n_emails + np.append(0, np.cumsum(listed.value_lengths().to_numpy()))
        users.append(np.frombuffer(_joined(part.column("users"))[1], np.int32) + np.repeat(begins[:-1], part.column("n").to_numpy()))
        emails.append(listed.flatten())
        n_emails = begins[-1]
        lengths.append(np.frombuffer(_joined(part.column("lengths"))[1], np.int32))
        data.append(_joined(part.column("terms"))[1])
        counts.append(np.frombuffer(_joined(part.column("counts"))[1], np.int32))
    offsets = np.append(0, np.cumsum(np.concatenate(lengths), dtype=np.int64))
    terms = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(data))]
    )
    return np.concatenate(users), pa.concat_arrays(emails), terms, np.concatenate(counts).astype(np.int64)


def _taken(values: pa.Array, places: np.ndarray) -> pa.Array:
    """Bytes as strings, as they are."""
    return values.take(pa.array(places)).cast(pa.binary()).view(pa.string())


def _sum_group(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, emails, terms, counts = _pairs(parts)
    user, emails = _codes(emails)
    user = user[places]
    term, terms = _codes(terms)
    total = np.zeros(len(terms), np.int64)
    np.add.at(total, term, counts)
    key = user * len(terms) + term
    order = np.argsort(key)
    key = key[order]
    first = _starts(key)
    k11 = np.add.reduceat(counts[order], first)
    user, term = np.divmod(key[first], len(terms))
    step = _rows_in(len(terms), terms.nbytes, BATCH_BYTES, BATCH_ROWS)
    for start in range(0, len(first), step):
        some = slice(start, start + step)
        yield pa.RecordBatch.from_arrays(
            [
                emails.take(pa.array(user[some])).cast(pa.string()),
                _taken(terms, term[some]),
                pa.array(k11[some]),
                pa.array(total[term[some]]),
            ],
            names=["email", "term", "k11", "term_total"],
        )


def _sum_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and totals of parts in the order of their buckets: some whole buckets at once."""
    held, rows, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, n = batch.column("bucket").to_numpy(), batch.column("n").to_numpy()
        begin = _starts(bucket)
        for start, end in zip(begin, np.append(begin[1:], len(bucket)), strict=True):
            if rows >= GROUP_ROWS and bucket[start] != last:
                yield from _sum_group(held)
                held, rows = [], 0
            held.append(batch.slice(start, end - start))
            rows += n[start:end].sum()
            last = bucket[start]
    if held:
        yield from _sum_group(held)


def _pair_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts as one row per pair, as they were counted."""
    for batch in batches:
        for at in range(batch.num_rows):
            places, emails, terms, counts = _pairs([batch.slice(at, 1)])
            step = _rows_in(len(terms), terms.nbytes, BATCH_BYTES, BATCH_ROWS)
            for start in range(0, len(places), step):
                some = slice(start, start + step)
                term = _taken(terms, np.arange(len(terms))[some])
                email = emails.take(pa.array(places[some])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([email, term, pa.array(counts[some])], names=["email", "term", "k"])


def counted_terms(
    pieces: DataFrame, shingle_size: int, share: int = SHARE, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Occurrences ``k11`` per (user, term) with the ``term_total`` of all users.

    ``pieces`` are those of ``user_terms(in_pieces=True)``; terms are as many words as
    ``shingle_size`` at most. The counts of tasks are written to the shared folder, in buckets
    of terms. A bucket is added up by one worker, unless it is crowded, which a term of very many users
    makes it: its pairs are counted as rows, and :func:`attach_totals` cuts such terms into pieces.
    """
    parts = pieces.select("email", "context", "words").mapInArrow(lambda b: _count_parts(b, shingle_size), PARTS)
    parts = stage(parts, "term-parts")
    # a row per bucket
    sizes = {r.bucket: r.n for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    pairs = sum(sizes.values())
    most = max(piece_rows, CROWDED * pairs // BUCKETS)
    crowded = [b for b, n in sizes.items() if n > most]
    tasks = max(pieces.sparkSession.sparkContext.defaultParallelism, -(-pairs // TASK_ROWS))
    plain = parts.filter(~F.col("bucket").isin(crowded)) if crowded else parts
    counts = plain.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_sum_parts, COUNTS)
    if not crowded:
        return counts
    rows = parts.filter(F.col("bucket").isin(crowded)).mapInArrow(_pair_rows, PAIRS)
    hot = stage(rows.groupBy("email", "term").agg(F.sum("k").alias("k11")), "crowded-counts")
    totals = stage(key_totals(hot, ["term"], "term_total"), "crowded-totals")
    return counts.unionByName(attach_totals(hot, totals, ["term"], "term_total", "email", share, piece_rows))
