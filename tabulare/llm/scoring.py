"""A hierarchical Pitman-Yor language model: restaurants by context share a parent, seating is sampled by Gibbs.

The contexts of a token are four deep: all text, its language, in a language
the kind of token before it, and that token itself. A restaurant gives a word
``(c - d t + (theta + d T) p) / (theta + C)``: ``c`` of its ``C`` customers eat
the word at ``t`` of its ``T`` tables, and ``p`` is the word's probability in
the parent, in which each of those tables is a customer. Above them all each
word has the same probability.

Texts are numbered once, in batches of one language. A pair of neighbouring
words goes from each batch to a shard by its hash, and its count comes back;
one of its batches owns it, and seats its customers. Words go to shards in the
same way, once and with their bytes; what a shard and a batch tell each other
later are arrays in the order of that first message.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulare.llm.rows import slices, without_collector, words
from tabulare.session import work_table

END = b""  # no word is empty
KINDS = [b" ", b"\t", b"\n", b"\r"]  # of the token before: none, one that ends a sentence, a short one, another
STOPS = (b".", b"!", b"?", b":", b";")
SHORT = 3
HELD_WORDS, HELD_TOKENS, HELD_BYTES = 600_000, 4_000_000, 64_000_000
SHARD_TOKENS, SHARD_BYTES = 4_000_000, 64_000_000
BLOCK_LEAVES = BLOCK_PAIRS = 250_000
THETA = 1.0
BURN_IN, SAMPLES = 2, 4
EXACT_SEATS = 24
NO_ID = -(1 << 63)


class Numbers(dict):
    """A number for each word, in the order in which words are first asked for; the end, which follows every text, is 0."""

    def __init__(self) -> None:
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def kinds_of(names: pa.Array) -> np.ndarray:
    """The kind that each word is of for the token after it, as a place in ``KINDS``; after the end there is none."""
    stops = pc.is_in(pc.binary_slice(names, -1), value_set=pa.array(STOPS, pa.binary())).to_numpy(zero_copy_only=False)
    sizes = pc.binary_length(names).to_numpy(zero_copy_only=False)
    return np.where(sizes == 0, 0, np.where(stops, 1, np.where(sizes <= SHORT, 2, 3)))


def word_numbers(texts: list[bytes], numbers: dict[bytes, int]) -> np.ndarray:
    """The words of all texts, each with its end, as numbers in one row."""
    return np.fromiter(map(numbers.__getitem__, chain.from_iterable([*words(raw), END] for raw in texts)), np.int64)


def in_context(row: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Each token with the kind of the one before as one number: the word's, times the kinds, and the kind."""
    before = np.zeros(len(row), np.int64)
    before[1:] = kinds[row[:-1]]
    return row * len(KINDS) + before


class Tally:
    """The tokens in context of some texts: how often each occurs in those in training, and in the others."""

    def __init__(self) -> None:
        self.numbers = Numbers()
        self.trained = self.others = np.zeros(0, np.int64)

    def add(self, trained: list[bytes], others: list[bytes]) -> None:
        self.count([word_numbers(texts, self.numbers) for texts in (trained, others)])

    def count(self, rows: list[np.ndarray]) -> None:
        kinds = kinds_of(pa.array(list(self.numbers), pa.binary()))
        size = len(kinds) * len(KINDS)
        counts = [np.bincount(in_context(row, kinds), minlength=size) for row in rows]
        for count, old in zip(counts, (self.trained, self.others), strict=True):
            count[: len(old)] += old
        self.trained, self.others = counts

    def batch(self, batch: int, lang: str) -> pa.RecordBatch:
        """A row per token in context with its count in training, 0 for those in other texts alone."""
        at = np.flatnonzero(self.trained + self.others)
        names = pa.array(list(self.numbers), pa.binary()).take(pa.array(at // len(KINDS)))
        kinds = pa.array(KINDS, pa.binary()).take(pa.array(at % len(KINDS)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(at), batch, np.int64)),
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(at), np.int64))),
                pc.binary_join_element_wise(names, kinds, pa.scalar(b"", pa.binary())),
                pa.array(self.trained[at]),
            ],
            names=["_batch", "_lang", "_token", "_n"],
        )


def in_training(key: Column, folds: int = 7, held_out: int = 2) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds != held_out


def prepared(docs: DataFrame, key: str, text: str, stratum: str) -> DataFrame:
    """The rows that the tasks read."""
    return docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("_id"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_lang"),
        in_training(F.col(key)).alias("_train"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
    )


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each occurs."""
    ordered = np.sort(values)
    first = np.flatnonzero(fresh(ordered))
    return ordered[first], np.diff(first, append=len(ordered))


def fresh(ordered: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    found = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=found[1:])
    return found


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def restored(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True)


class Batch:
    """Documents of one language as numbers of words: tokens in one row, and the different pairs of neighbours in order."""

    def __init__(self, lang: str, names: bytes, row: bytes, train: bytes) -> None:
        self.lang, self.names = lang, restored(names).split(b" ")
        self.kinds = kinds_of(pa.array(self.names, pa.binary()))
        self.row = np.frombuffer(restored(row), "<u4").astype(np.int64)
        self.ends = np.flatnonzero(self.row == 0)
        self.trained = np.repeat(np.frombuffer(train, bool), np.diff(self.ends, prepend=-1))
        self.paired = self.row.copy()
        self.paired[1:] += self.row[:-1] * len(self.kinds)
        self.pairs = runs(self.paired)[0]
        self.before, self.word = np.divmod(self.pairs, len(self.kinds))
        codes = self.word * len(KINDS) + self.kinds[self.before]
        held = np.zeros(len(self.kinds) * len(KINDS), bool)
        held[codes] = True
        self.entries, self.entry = np.flatnonzero(held), np.cumsum(held)[codes] - 1
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names), np.uint64, len(self.names))

    def own_counts(self) -> np.ndarray:
        """How often each pair occurs in the training documents of this batch."""
        found, times = runs(self.paired[self.trained])
        counts = np.zeros(len(self.pairs), np.int64)
        counts[np.searchsorted(self.pairs, found)] = times
        return counts

    def dealt(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each pair as 64 bits that are the same in all batches of the language, its shard, and the order by shard."""
        seed = np.uint64(xxhash.xxh3_64_intdigest(self.lang.encode()))
        keys = ((self.hashes ^ seed) * MIX[0])[self.before] ^ (self.hashes + MIX[1])[self.word]
        keys = (keys ^ (keys >> np.uint64(30))) * MIX[2]
        keys ^= keys >> np.uint64(31)
        return keys, *by_shard(keys, shards)

    def dealt_entries(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard of each entry, which is that of its word in all batches, and the order by shard."""
        return by_shard(self.hashes[self.entries // len(KINDS)], shards)

    def totals(self, answers: list[dict], shards: int) -> tuple[np.ndarray, np.ndarray]:
        """What the shards answered: each pair's count in training, and whether it is this batch's to seat."""
        coded = np.frombuffer(b"".join(restored(a["_small"]) for a in answers), np.uint8).astype(np.int64)
        coded[coded == 255] = np.frombuffer(b"".join(a["_large"] for a in answers), "<i8")
        found = np.empty(len(coded), np.int64)
        found[self.dealt(shards)[2]] = coded
        return found >> 1, found & 1 == 1

    def by_token(self, values: np.ndarray) -> np.ndarray:
        """The values of pairs for each token, in parts that are sorted first: that is quicker, and one part at a time is small."""
        found = np.empty(len(self.paired))
        for part, to in zip(*(np.split(v, range(BLOCK_PAIRS, len(v), BLOCK_PAIRS)) for v in (self.paired, found)), strict=True):
            order = np.argsort(part)
            to[order] = values[np.searchsorted(self.pairs, part[order])]
        return found

    def asked(self, total: np.ndarray, owned: np.ndarray) -> np.ndarray:
        """Which entries a sweep over the pairs needs: those of owned pairs with customers to seat, and one of each word before."""
        several = owned & (total > 1)
        asked = np.bincount(self.entry[several], minlength=len(self.entries)) > 0
        return asked | (per_word(self, np.bincount(self.before[several], minlength=len(self.names))) > 0)


def by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    shard = (keys % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
    return shard, np.argsort(shard, kind="stable")


MIX = [np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xBF58476D1CE4E5B9)]


def numbered_batches(rows: DataFrame) -> DataFrame:
    """The texts as numbers: a row per batch, with its documents one after the other, its words, how many tokens it has, and
    how many bytes its words."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        held: dict = {}
        held_bytes = 0

        def taken() -> Iterator[pa.RecordBatch]:
            nonlocal place, held_bytes
            for lang, (numbers, ids, train, parts) in held.items():
                row, flags = np.concatenate(parts).astype("<u4"), np.array(train, bool).tobytes()
                names = b" ".join(numbers)
                values = (place, lang, np.array(ids, "<i8").tobytes(), flags, squeezed(row.tobytes()), squeezed(names), len(row), len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(values, BATCH_KINDS, strict=True)], names=BATCH_NAMES
                )
                place += 1
            held.clear()
            held_bytes = 0

        for part in slices(batches):
            held_bytes += pc.sum(pc.binary_length(part.column("_text"))).as_py()
            texts: dict = defaultdict(lambda: ([], [], []))
            columns = (part.column(name).to_pylist() for name in ("_lang", "_id", "_train", "_text"))
            for lang, *fields in zip(*columns, strict=True):
                for column, value in zip(texts[lang], fields, strict=True):
                    column.append(value)
            with without_collector():
                for lang, (ids, train, raws) in texts.items():
                    numbers, all_ids, all_train, parts = held.setdefault(lang, (Numbers(), [], [], []))
                    parts.append(word_numbers(raws, numbers).astype(np.uint32))
                    all_ids += ids
                    all_train += train
            sizes = [(len(numbers), sum(map(len, parts))) for numbers, _, _, parts in held.values()]
            if sum(n for n, _ in sizes) > HELD_WORDS or sum(n for _, n in sizes) > HELD_TOKENS or held_bytes > HELD_BYTES:
                yield from taken()
        yield from taken()

    return rows.mapInArrow(number, BATCH_SCHEMA)


BATCH_NAMES = ["_batch", "_lang", "_ids", "_train", "_row", "_names", "_tokens", "_bytes"]
BATCH_KINDS = [pa.int64(), pa.string(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
BATCH_SCHEMA = "_batch bigint, _lang string, _ids binary, _train binary, _row binary, _names binary, _tokens bigint, _bytes bigint"


def opened(rows: pa.RecordBatch, i: int) -> tuple[int, Batch]:
    """The number of a batch, and the batch; to be handed on at once, so that no two are held."""
    place, *fields = (rows.column(n)[i].as_py() for n in ("_batch", "_lang", "_names", "_row", "_train"))
    return place, Batch(*fields)


def coded_totals(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Twice the sum of the counts of each key, at all its places, and one more at its first. Keys are hashes, and are
    taken in parts by their highest bits, so that little is held besides them."""
    coded, high = np.empty(len(keys), np.int64), (keys >> np.uint64(61)).astype(np.uint8)
    for part in range(8):
        at = np.flatnonzero(high == part)
        at = at[np.argsort(keys[at], kind="stable")]
        if len(at):
            first = np.flatnonzero(fresh(keys[at]))
            total = np.add.reduceat(counts[at], first, dtype=np.int64)
            coded[at] = np.repeat(2 * total, np.diff(first, append=len(at)))
            coded[at[first]] += 1
    return coded


def pair_totals(batches: DataFrame, shards: int) -> DataFrame:
    """Per batch and shard, in the order of the batch's keys: each pair's count in training, twice, and one more for its owner.

    Counts of up to 127 take a byte each, ``_large`` has the others in order.
    ``_once`` and ``_twice`` are how many owned pairs have one and two customers.
    """

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for i in range(part.num_rows):
                yield dealt(*opened(part, i))

    def dealt(place: int, batch: Batch) -> pa.RecordBatch:
        keys, of, order = batch.dealt(shards)
        counts = batch.own_counts().astype("<u4")
        edges = np.searchsorted(of[order], np.arange(shards + 1)).tolist()
        keys, counts = keys[order], counts[order]
        spans = [(s, a, b) for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]
        return pa.RecordBatch.from_pydict(
            {
                "_batch": pa.array([place] * len(spans), pa.int64()),
                "_shard": pa.array([s for s, _, _ in spans], pa.int64()),
                "_keys": pa.array([keys[a:b].tobytes() for _, a, b in spans], pa.binary()),
                "_counts": pa.array([counts[a:b].tobytes() for _, a, b in spans], pa.binary()),
            }
        )

    def count(table: pa.Table) -> pa.Table:
        rows = np.argsort(table.column("_batch").to_numpy(), kind="stable").tolist()
        parts, own = ([np.frombuffer(table.column(c)[i].as_buffer(), k) for i in rows] for c, k in (("_keys", np.uint64), ("_counts", "<u4")))
        coded = coded_totals(np.concatenate(parts), np.concatenate(own))
        answers: list[list] = [[], [], [], []]
        for mine in np.split(coded, np.cumsum(list(map(len, parts)))[:-1]):
            values = squeezed(np.minimum(mine, 255).astype(np.uint8).tobytes()), mine[mine >= 255].astype("<i8").tobytes()
            for column, value in zip(answers, (*values, int((mine == 3).sum()), int((mine == 5).sum())), strict=True):
                column.append(value)
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64())
        return pa.Table.from_arrays(
            [*(table.column(c).take(pa.array(rows)) for c in ("_batch", "_shard")), *(pa.array(c, k) for c, k in zip(answers, kinds, strict=True))],
            names=["_batch", "_shard", "_small", "_large", "_once", "_twice"],
        )

    keyed = batches.mapInArrow(deal, "_batch bigint, _shard bigint, _keys binary, _counts binary")
    counted = keyed.groupBy("_shard").applyInArrow(
        count, "_batch bigint, _shard bigint, _small binary, _large binary, _once bigint, _twice bigint"
    )
    return counted.groupBy("_batch").agg(
        F.sort_array(F.collect_list(F.struct("_shard", "_small", "_large"))).alias("_totals"),
        F.sum("_once").alias("_once"),
        F.sum("_twice").alias("_twice"),
    )


def entry_rows(batches: DataFrame, shards: int) -> DataFrame:
    """Per batch and shard: its words, each followed by a blank, and its entries, which are tokens in context in their order.

    ``_values`` has four rows: the entry's word among those, its kind before and
    whether it is asked for; its count in training; the pairs that send a customer
    to it; and the tables of its word's own restaurant, once per word. Both as with
    one table per owned pair.
    """

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for i in range(part.num_rows):
                yield counted(*opened(part, i), part.column("_totals")[i].as_py())

    def counted(place: int, batch: Batch, totals: list[dict]) -> pa.RecordBatch:
        total, owned = batch.totals(totals, shards)
        tally = Tally()
        tally.numbers.update(zip(batch.names, range(len(batch.names)), strict=True))
        tally.count([batch.row[batch.trained], batch.row[~batch.trained]])
        seated = owned & (total > 0)
        customers = np.bincount(batch.entry[seated], minlength=len(batch.entries))
        tables = per_word(batch, np.bincount(batch.before[seated], minlength=len(batch.names)))
        shard, order = batch.dealt_entries(shards)
        word, kind = np.divmod(batch.entries[order], len(KINDS))
        first = np.diff(word, prepend=-1) != 0
        number = np.cumsum(first) - 1  # of the word among all, in the order of shards
        sent = pc.binary_join_element_wise(pa.array(batch.names, pa.binary()).take(pa.array(word[first])), b"", b" ")
        ends, data = np.frombuffer(sent.buffers()[1], "<i4"), memoryview(sent.buffers()[2])
        edges = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
        spans = [(s, a, b) for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]
        asked = batch.asked(total, owned)[order]
        rest = np.stack([tally.trained[batch.entries], customers, tables])[:, order]
        names, values = [], []
        for _, a, b in spans:
            names.append(squeezed(bytes(data[ends[number[a]] : ends[number[b - 1] + 1]])))
            code = ((number[a:b] - number[a]) * len(KINDS) + kind[a:b]) * 2 + asked[a:b]
            values.append(squeezed(np.concatenate([code[None], rest[:, a:b]]).astype("<i8").tobytes()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([place] * len(spans), pa.int64()), pa.array([s for s, _, _ in spans], pa.int64()),
                pa.array([batch.lang] * len(spans), pa.string()), pa.array(names, pa.binary()), pa.array(values, pa.binary()),
            ],
            names=["_batch", "_shard", "_lang", "_words", "_values"],
        )

    return batches.mapInArrow(count, "_batch bigint, _shard bigint, _lang string, _words binary, _values binary")


def per_word(batch: Batch, values: np.ndarray) -> np.ndarray:
    """Values of words, each at the first of the word's entries and 0 at the others."""
    word = batch.entries // len(KINDS)
    return np.where(np.diff(word, prepend=-1) != 0, values[word], 0)


def numbers_in(data: bytes, rows: int) -> np.ndarray:
    """Rows of numbers that were squeezed together."""
    return np.frombuffer(restored(data), "<i8").reshape(rows, -1)


def ended_words(data: bytes) -> pa.Array:
    """Words that are each followed by a blank, with it."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == ord(" ")) + 1
    offsets = np.concatenate([[0], ends]).astype("<i4")
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


LEAF = ("word", "lang", "kind", "n", "seen", "seats", "more")
SHARD_SCHEMA = (
    "_shard bigint, _langs array<string>, _leaves binary, _batches array<bigint>, _at array<binary>, _tokens bigint, _types bigint"
)


def word_shards(entries: DataFrame) -> DataFrame:
    """One row per shard. ``_leaves`` has the rows of ``LEAF``: number of the word, place of the language in ``_langs`` and of
    the kind before, customers, count in training, and the tables of the restaurant after the word, with those beyond one
    per pair. ``_at`` has, for each of ``_batches``, the leaf of each entry, twice, and one more if it is asked for. ``_tokens`` and
    ``_types`` are the tokens in training and their different words. Words are compared as bytes and then numbers."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("_batch")
        names = [ended_words(restored(data)) for data in table.column("_words").to_pylist()]
        starts = np.cumsum([0, *map(len, names)])
        word = pa.concat_arrays(names).dictionary_encode().indices.to_numpy()
        given = [numbers_in(data, 4) for data in table.column("_values").to_pylist()]
        sizes = [g.shape[1] for g in given]
        code, seen, customers, tables = np.concatenate(given, 1)
        code, asked = np.divmod(code, 2)
        at, kind = np.divmod(code, len(KINDS))
        langs = sorted(set(table.column("_lang").to_pylist()))
        lang = np.repeat([langs.index(x) for x in table.column("_lang").to_pylist()], sizes)
        keys = (word[at + np.repeat(starts[:-1], sizes)].astype(np.int64) * len(langs) + lang) * len(KINDS) + kind
        found, leaf = np.unique(keys, return_inverse=True)
        summed = [np.bincount(leaf, values).astype(np.int64) for values in (customers, seen, tables)]
        of, kind = np.divmod(found, len(KINDS))
        of, lang = np.divmod(of, len(langs))
        known = np.bincount(of, summed[1])
        leaves = np.stack([of, lang, kind, *summed, np.zeros(len(found), np.int64)])
        places = [squeezed(p.astype("<i8").tobytes()) for p in np.split(2 * leaf + asked, np.cumsum(sizes)[:-1])]
        values = (
            table.column("_shard")[0].as_py(), langs, squeezed(leaves.astype("<i8").tobytes()), table.column("_batch").to_pylist(),
            places, int(known.sum()), int((known > 0).sum()),
        )
        return shard_row(*values)

    return entries.groupBy("_shard").applyInArrow(merge, SHARD_SCHEMA)


def shard_row(*values) -> pa.Table:
    kinds = (pa.int64(), pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.int64(), pa.int64())
    names = [field.split()[0] for field in SHARD_SCHEMA.split(", ")]
    return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


def seat_table(discount: float, most: int = EXACT_SEATS) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: the weight of c customers of one word at t tables."""
    table = np.full((most + 1, most + 1), -np.inf)
    table[0, 0] = 0
    for c in range(1, most + 1):
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(c - 1 - discount * np.arange(most + 1), 0)) + table[c - 1]
        table[c] = np.logaddexp(np.concatenate([[-np.inf], table[c - 1, :-1]]), stay)
    return table


def draw_tables(counts: np.ndarray, weight: np.ndarray, discount: float, table: np.ndarray, rng) -> np.ndarray:
    """Draw at how many tables each word's customers sit, given the weight of a new table for the word.

    Up to ``EXACT_SEATS`` customers the number is drawn from its distribution
    given everything else. Above, the first ones are seated so and the others
    in groups of an eighth of those seated, which choose new tables or old ones
    by the odds that the group's first finds.
    """
    seated = np.minimum(counts, EXACT_SEATS)
    tables = np.minimum(counts, 1)
    log_weight = np.log(np.maximum(weight, 1e-300))
    for c in range(2, EXACT_SEATS + 1):
        at = np.flatnonzero(seated == c)
        if len(at):
            options = np.arange(1, c + 1) * log_weight[at, None] + table[c, 1 : c + 1]
            odds = np.cumsum(np.exp(options - options.max(1, keepdims=True)), 1)
            tables[at] = 1 + (odds < rng.random((len(at), 1)) * odds[:, -1:]).sum(1)
    at = np.flatnonzero(counts > EXACT_SEATS)
    done = seated[at]
    while len(at):
        group = np.minimum(np.maximum(done // 8, 1), counts[at] - done)
        fresh = weight[at] / (weight[at] + done - discount * tables[at])
        tables[at] += rng.binomial(group, np.clip(fresh, 0, 1))
        done = done + group
        more = done < counts[at]
        at, done = at[more], done[more]
    return tables


def mean_tables(counts: np.ndarray, weight: np.ndarray, discount: float, table: np.ndarray) -> np.ndarray:
    """The mean of what ``draw_tables`` draws: exact up to ``EXACT_SEATS`` customers, above with groups that choose by the mean."""
    seated = np.minimum(counts, EXACT_SEATS)
    mean = np.minimum(counts, 1).astype(float)
    log_weight = np.log(np.maximum(weight, 1e-300))
    for c in range(2, EXACT_SEATS + 1):
        at = np.flatnonzero(seated == c)
        if len(at):
            options = np.arange(1, c + 1) * log_weight[at, None] + table[c, 1 : c + 1]
            odds = np.exp(options - options.max(1, keepdims=True))
            mean[at] = odds @ np.arange(1, c + 1) / odds.sum(1)
    at = np.flatnonzero(counts > EXACT_SEATS)
    done = seated[at]
    while len(at):
        group = np.minimum(np.maximum(done // 8, 1), counts[at] - done)
        mean[at] += group * np.clip(weight[at] / (weight[at] + done - discount * mean[at]), 0, 1)
        done = done + group
        more = done < counts[at]
        at, done = at[more], done[more]
    return mean


def discount_of(once: int, twice: int) -> float:
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5


class Totals:
    """Per restaurant its customers and tables, and per level the discount: small tables, one row per context."""

    def __init__(self, rows: list, vocabulary: int) -> None:
        self.base = 1 / (vocabulary + 1)
        self.contexts = {(r.level, r.context): (float(r.customers), float(r.tables)) for r in rows}
        self.discounts = {}
        for level in (0, 1, 2):
            once = sum(r.once for r in rows if r.level == level)
            twice = sum(r.twice for r in rows if r.level == level)
            self.discounts[level] = discount_of(once, twice)

    def of(self, level: int, contexts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.contexts.get((level, c), (0.0, 0.0)) for c in contexts]
        return np.array([c for c, _ in found]), np.array([t for _, t in found])


class Seating:
    """The restaurants' rows of some words: leaves (language and kind), middles (language) and the top, per word."""

    def __init__(self, langs: list[str], word, lang, kind, counts, seen=None, seats=None, more=None) -> None:
        self.langs, self.word, self.lang, self.kind, self.counts = langs, word, lang, kind, counts
        # Customers that come from no restaurants of words are tokens.
        self.seen, self.seats, self.more = (counts if v is None else v for v in (seen, seats, more))
        self.place = lang * len(KINDS) + kind
        self.place_names = [f"{k.decode()}{x}" for x in langs for k in KINDS]
        pairs, self.middle = np.unique(word * len(langs) + lang, return_inverse=True)
        self.middle_lang, self.top = pairs % len(langs), pairs // len(langs)
        self.words = int(word[-1]) + 1
        self.leaf_tables = np.minimum(self.counts, 1)
        self._sum()
        self.middle_tables = np.minimum(self.middle_counts, 1)
        self._sum()
        self.top_tables = np.minimum(self.top_counts, 1)

    @classmethod
    def of_rows(cls, batch: pa.RecordBatch) -> Seating:
        """That of a table with a row per word."""
        leaves = batch.column("_leaves")
        flat = leaves.flatten()
        word = np.repeat(np.arange(len(leaves)), np.diff(leaves.offsets.to_numpy()))
        langs, lang = np.unique(np.array(flat.field("_lang").to_pylist(), object).astype(str), return_inverse=True)
        kind = np.array([KINDS.index(k) for k in flat.field("_kind").to_pylist()])
        return cls(langs.tolist(), word, lang, kind, flat.field("_n").to_numpy().astype(np.int64))

    def _sum(self) -> None:
        self.middle_counts = np.bincount(self.middle, self.leaf_tables, len(self.top)).astype(np.int64)
        tables = getattr(self, "middle_tables", self.middle_counts)
        self.top_counts = np.bincount(self.top, tables, self.words).astype(np.int64)

    def sweep(self, totals: Totals, tables: list[np.ndarray], rng) -> None:
        """Seat the customers of every row anew, given all others: leaves first, then what that sends to the parents."""
        d0, d1, d2 = (totals.discounts[i] for i in (0, 1, 2))
        (c0, t0), (c1, t1), (_, t2) = self._totals(totals)
        # The row's own tables leave the parent before it is asked.
        above = (np.maximum(self.top_counts - d0 * self.top_tables, 0) + (THETA + d0 * t0) * totals.base) / (THETA + c0)
        rest = self.middle_counts[self.middle] - self.leaf_tables
        held = np.minimum(self.middle_tables[self.middle], rest)
        lang = self.middle_lang[self.middle]
        parent = (np.maximum(rest - d1 * held, 0) + (THETA + d1 * t1[lang]) * above[self.word]) / (THETA + c1[lang])
        self.leaf_tables = draw_tables(self.counts, (THETA + d2 * t2[self.place]) * parent, d2, tables[2], rng)
        self._sum()
        rest = self.top_counts[self.top] - self.middle_tables
        held = np.minimum(self.top_tables[self.top], rest)
        parent = (np.maximum(rest - d0 * held, 0) + (THETA + d0 * t0) * totals.base) / (THETA + c0)
        weight = (THETA + d1 * t1[self.middle_lang]) * parent
        self.middle_tables = draw_tables(self.middle_counts, weight, d1, tables[1], rng)
        self._sum()
        weight = np.full(self.words, (THETA + d0 * t0) * totals.base)
        self.top_tables = draw_tables(self.top_counts, weight, d0, tables[0], rng)

    def _totals(self, totals: Totals) -> list:
        top, middle = totals.of(0, [""]), totals.of(1, self.langs)
        return [(top[0][0], top[1][0]), middle, totals.of(2, self.place_names)]

    def predictive(self, totals: Totals) -> np.ndarray:
        """The probability of the word at each leaf under this seating, and with one of its customers gone."""
        d0, d1, d2 = (totals.discounts[i] for i in (0, 1, 2))
        (c0, t0), (c1, t1), (c2, t2) = self._totals(totals)
        top = (self.top_counts - d0 * self.top_tables + (THETA + d0 * t0) * totals.base) / (THETA + c0)
        lang = self.middle_lang
        middle = (
            self.middle_counts - d1 * self.middle_tables + (THETA + d1 * t1[lang]) * top[self.top]
        ) / (THETA + c1[lang])
        rest = np.maximum(self.counts - 1, 0)
        own = np.array([self.counts - d2 * self.leaf_tables, rest - d2 * np.minimum(self.leaf_tables, rest)])
        return (own + (THETA + d2 * t2[self.place]) * middle[self.middle]) / (THETA + c2[self.place])

    def summary(self) -> pa.RecordBatch:
        """What this batch adds to each restaurant's customers and tables, and how many words have one or two customers."""
        levels = [
            (0, [""], np.zeros(self.words, int), self.top_counts, self.top_tables),
            (1, self.langs, self.middle_lang, self.middle_counts, self.middle_tables),
            (2, self.place_names, self.place, self.counts, self.leaf_tables),
        ]
        rows: dict = defaultdict(list)
        for level, names, of, counts, seats in levels:
            sums = [np.bincount(of, v, len(names)).astype(int) for v in (counts, seats, counts == 1, counts == 2)]
            for i, name in enumerate(names):
                values = (level, name, *(int(s[i]) for s in sums))
                for column, value in zip(("level", "context", "customers", "tables", "once", "twice"), values, strict=True):
                    rows[column].append(value)
        return pa.RecordBatch.from_pydict(rows, SUMMARY)


SUMMARY = pa.schema(
    [("level", pa.int64()), ("context", pa.string()), *((c, pa.int64()) for c in ("customers", "tables", "once", "twice"))]
)


def seatings(rows: pa.RecordBatch, step: int) -> Iterator[tuple[Seating, np.random.Generator]]:
    """The words of a table by row, or of each shard in blocks, with random numbers that are the same when a lost task is run again."""
    if "_shard" not in rows.schema.names:
        yield Seating.of_rows(rows), np.random.default_rng([step, len(rows), *rows.column("_word")[0].as_py()[:64]])
        return
    for i in range(rows.num_rows):
        yield from blocks(rows, i, step)


def blocks(rows: pa.RecordBatch, i: int, step: int) -> Iterator[tuple[Seating, np.random.Generator]]:
    """Those of one shard, cut between words."""
    leaves, langs = numbers_in(rows.column("_leaves")[i].as_py(), len(LEAF)), rows.column("_langs")[i].as_py()
    first = np.flatnonzero(np.diff(leaves[0], prepend=-1))
    edges = first[np.unique(np.searchsorted(first, np.arange(0, leaves.shape[1], BLOCK_LEAVES)).clip(max=len(first) - 1))]
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), leaves.shape[1]], strict=True):
        word, *rest = leaves[:, a:b]
        yield Seating(langs, word - word[0], *rest), np.random.default_rng([step, rows.column("_shard")[i].as_py(), a])


def seating_totals(word_table: DataFrame, vocabulary: int, before: Totals | None) -> Totals:
    """The totals of all restaurants: with each word at one table first, then after ``BURN_IN`` sweeps."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seats = before and [seat_table(before.discounts[level]) for level in (0, 1, 2)]
        for batch in batches:
            if batch.num_rows:
                for seating, rng in seatings(batch, 1):
                    for _ in range(BURN_IN if before else 0):
                        seating.sweep(before, seats, rng)
                    yield seating.summary()

    summed = [F.sum(c).alias(c) for c in ("customers", "tables", "once", "twice")]
    schema = "level bigint, context string, customers bigint, tables bigint, once bigint, twice bigint"
    found = word_table.mapInArrow(total, schema).groupBy("level", "context").agg(*summed)
    return Totals(found.collect(), vocabulary)  # one row per context


def mean_chances(seating: Seating, rng: np.random.Generator, totals: Totals, samples: int) -> np.ndarray:
    """What ``Seating.predictive`` says, averaged over ``samples`` seatings."""
    seats = [seat_table(totals.discounts[level]) for level in (0, 1, 2)]
    mean = np.zeros((2, len(seating.counts)))
    for step in range(BURN_IN + samples):
        seating.sweep(totals, seats, rng)
        if step >= BURN_IN:
            mean += seating.predictive(totals) / samples
    return mean


def predictive_rows(word_table: DataFrame, totals: Totals, samples: int = SAMPLES) -> DataFrame:
    """For a table with a row per word: per language and token in context its averaged probability ``_p``, and ``_q``, that
    with one customer gone."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (seating, rng), = seatings(batch, 2)
            mean = mean_chances(seating, rng, totals, samples)
            names = batch.column("_word").to_pylist()
            tokens = [names[w] + KINDS[k] for w, k in zip(seating.word, seating.kind, strict=True)]
            langs = [seating.langs[x] for x in seating.lang]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(tokens, pa.binary()), *map(pa.array, mean)], names=["_l", "_t", "_p", "_q"]
            )

    return word_table.mapInArrow(predict, "_l string, _t binary, _p double, _q double")


def looked_up(words: DataFrame, totals: Totals, samples: int, shards: int, asked: bool) -> DataFrame:
    """What the shards tell each batch, of all its entries or those asked for, by shard and in their order.

    ``_chances`` has the averaged probabilities, and those with one customer gone.
    ``_counts`` has, once per word, its count in training, and in the batch's language
    customers and tables of the restaurant after it, and the tables beyond one per pair.
    """

    def answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for i in range(part.num_rows):
                chances, counts = [], []
                for seating, rng in blocks(part, i, 2):
                    chances.append(mean_chances(seating, rng, totals, samples))
                    known = np.bincount(seating.word, seating.seen)[seating.word]
                    after = (np.bincount(seating.middle, v)[seating.middle] for v in (seating.seen, seating.seats, seating.more))
                    counts.append(np.stack([known, *after]).astype("<i8"))
                word = numbers_in(part.column("_leaves")[i].as_py(), len(LEAF))[0]
                yield told(part, i, word, np.concatenate(chances, 1).astype("<f4"), np.concatenate(counts, 1))

    def told(part: pa.RecordBatch, i: int, word: np.ndarray, chances: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        found: list[tuple] = []
        for place, data in zip(part.column("_batches")[i].as_py(), part.column("_at")[i].as_py(), strict=True):
            leaf, wanted = np.divmod(numbers_in(data, 1)[0], 2)
            leaf = leaf[wanted == 1] if asked else leaf
            if len(leaf):
                once = leaf[np.diff(word[leaf], prepend=-1) != 0]
                found.append((place, squeezed(chances[:, leaf].tobytes()), squeezed(counts[:, once].tobytes())))
        columns = [pa.array([f[n] for f in found], kind) for n, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))]
        shard = pa.array([part.column("_shard")[i].as_py()] * len(found), pa.int64())
        return pa.RecordBatch.from_arrays([shard, *columns], names=["_shard", "_of", "_chances", "_counts"])

    told_rows = words.mapInArrow(answer, "_shard bigint, _of bigint, _chances binary, _counts binary")
    listed = F.sort_array(F.collect_list(F.struct("_shard", "_chances", "_counts")))
    return told_rows.groupBy("_of").agg(listed.alias("_answers")).withColumn("_shards", F.lit(shards))


def entry_values(batch: Batch, answers: list[dict], shards: int, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Chances by entry and counts by word as ``looked_up`` has them, 0 where nothing was looked up."""
    _, order = batch.dealt_entries(shards)
    order = order if asked is None else order[asked[order]]
    chances, counts = np.zeros((2, len(batch.entries))), np.zeros((4, len(batch.names)), np.int64)
    if answers:
        chances[:, order] = np.concatenate([np.frombuffer(restored(a["_chances"]), "<f4").reshape(2, -1) for a in answers], 1)
        word = batch.entries[order] // len(KINDS)
        counts[:, word[np.diff(word, prepend=-1) != 0]] = np.concatenate([numbers_in(a["_counts"], 4) for a in answers], 1)
    return chances, counts


def pair_chances(batch: Batch, total: np.ndarray, dictionary: pa.RecordBatch | pa.Table, discount: float, i: int = 0) -> np.ndarray:
    """The probability of each pair's word after the word before it, given how often the pair occurs in training, and
    what row ``i`` of ``looked_up`` says."""
    return chances_and_known(batch, total, dictionary, discount, i)[0]


def chances_and_known(
    batch: Batch, total: np.ndarray, dictionary: pa.RecordBatch | pa.Table, discount: float, i: int
) -> tuple[np.ndarray, np.ndarray]:
    """These probabilities, and the count of each word in training."""
    answers, shards = (dictionary.column(name)[i].as_py() for name in ("_answers", "_shards"))
    (chance, less), (known, heads, tables, more) = entry_values(batch, answers, shards)
    seats, own = seat_table(discount), np.empty(len(batch.pairs))
    for a in range(0, len(own), BLOCK_PAIRS):
        here = slice(a, a + BLOCK_PAIRS)
        n, before, entry = total[here], batch.before[here], batch.entry[here]
        # The mean is that of the sweep in which the tables were counted, so that probabilities add up to about 1.
        weight = (THETA + discount * (tables - more)[before]) * less[entry]
        mean = mean_tables(n, weight, discount, seats)
        own[here] = (n - discount * mean + (THETA + discount * tables[before]) * chance[entry]) / (THETA + heads[before])
    return own, known


def seated_pairs(batches: DataFrame, asked: DataFrame, discount: float, shards: int) -> DataFrame:
    """A sweep over the restaurants of words: each batch seats the customers of its pairs anew.

    Per batch and shard, of the entries asked for in their order: how many customers
    more than one per pair are sent to each, and how many tables more the
    restaurant after its word has. What others hold is that of the sweep before, in which each pair had a table.
    """

    def seat(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for i in range(part.num_rows):
                yield seated(*opened(part, i), *(part.column(name)[i].as_py() for name in ("_totals", "_answers")))

    def seated(place: int, batch: Batch, totals: list[dict], answers: list[dict]) -> pa.RecordBatch:
        total, owned = batch.totals(totals, shards)
        asked = batch.asked(total, owned)
        (_, chance), (_, _, tables, _) = entry_values(batch, answers, shards, asked)
        at = np.flatnonzero(owned & (total > 1))
        weight = (THETA + discount * tables[batch.before[at]]) * chance[batch.entry[at]]
        drawn = draw_tables(total[at], weight, discount, seat_table(discount), np.random.default_rng([3, place])) - 1
        more = np.bincount(batch.entry[at], drawn, len(batch.entries)).astype(np.int64)
        after = per_word(batch, np.bincount(batch.before[at], drawn, len(batch.names)).astype(np.int64))
        shard, order = batch.dealt_entries(shards)
        order = order[asked[order]]
        found, first = np.unique(shard[order], return_index=True)
        both = np.split(np.stack([more, after])[:, order].astype("<i8"), first[1:], 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([place] * len(found), pa.int64()), pa.array(found.astype(np.int64)),
                pa.array([squeezed(b.tobytes()) for b, _ in zip(both, found, strict=False)], pa.binary()),
            ],
            names=["_from", "_to", "_more"],
        )

    return batches.join(asked, F.col("_batch") == F.col("_of")).mapInArrow(seat, "_from bigint, _to bigint, _more binary")


def seated_shards(words: DataFrame, more: DataFrame) -> DataFrame:
    """``words`` with what ``seated_pairs`` sends them."""

    def add(shard: pa.Table, sent: pa.Table) -> pa.Table:
        row = shard.to_pylist()[0]
        leaves = numbers_in(row["_leaves"], len(LEAF)).copy()
        at = dict(zip(row["_batches"], row["_at"], strict=True))
        for place, data in zip(sent.column("_from").to_pylist(), sent.column("_more").to_pylist(), strict=True):
            leaf, wanted = np.divmod(numbers_in(at[place], 1)[0], 2)
            customers, tables = numbers_in(data, 2)
            for name, values in (("n", customers), ("seats", tables), ("more", tables)):
                leaves[LEAF.index(name), leaf[wanted == 1]] += values  # a batch has a leaf once
        return shard_row(*(row | {"_leaves": squeezed(leaves.tobytes())}).values())

    return words.groupBy("_shard").cogroup(more.groupBy("_to")).applyInArrow(add, SHARD_SCHEMA)


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang"
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows in training only, from all of their tokens.
    ``score`` is the sum over tokens of log10 of the averaged predictive
    probability; divided by the tokens it gives the perplexity. Null and empty
    texts have the end as their only token; rows with null keys are in training
    by the checksum of the empty text; repeated rows count as often as they
    occur; a null language is one of its own; an empty table gives no rows.

    Words and the hashes of pairs travel as arrays, a row per batch of documents
    and shard, to the model and back. No table of words or of pairs is ever whole in one
    place, and no group holds more than a batch or a shard. Pairs are told apart by
    64 bits, words by their bytes.
    """
    rows = prepared(docs, key, text, stratum)
    numbered = work_table(numbered_batches(rows), "batches", "zstd")
    tokens, sent, held = (n or 0 for n in numbered.agg(F.sum("_tokens"), F.sum("_bytes"), F.count("*")).first())
    shards = 1 + max(tokens // SHARD_TOKENS, sent // SHARD_BYTES)
    answers = work_table(pair_totals(numbered, shards), "pair_totals")
    once, twice = answers.agg(F.sum("_once"), F.sum("_twice")).first()
    discount = discount_of(once or 0, twice or 0)
    # About one batch a task: all that a task has comes to Python at once.
    batches = numbered.repartition(max(held, 1), "_batch").join(answers.select(F.col("_batch").alias("_b"), "_totals"), F.col("_batch") == F.col("_b")).drop("_b")
    word_table = work_table(word_shards(entry_rows(batches, shards)), "words")
    training, vocabulary = (n or 0 for n in word_table.agg(F.sum("_tokens"), F.sum("_types")).first())

    asked = work_table(looked_up(word_table, seating_totals(word_table, vocabulary, None), 1, shards, True), "asked")
    word_table = work_table(seated_shards(word_table, seated_pairs(batches, asked, discount, shards)), "seated_words")
    totals = seating_totals(word_table, vocabulary, seating_totals(word_table, vocabulary, None))
    values = work_table(looked_up(word_table, totals, SAMPLES, shards, False), "looked_up")
    base_log = math.log10(training + vocabulary + 1)

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for i in range(part.num_rows):
                with without_collector():
                    yield scored(opened(part, i)[1], part, i)

    def scored(batch: Batch, part: pa.RecordBatch, i: int) -> pa.RecordBatch:
        ids, answers = (part.column(name)[i].as_py() for name in ("_ids", "_totals"))
        chances, known = chances_and_known(batch, batch.totals(answers, shards)[0], part, discount, i)
        found = np.log10(chances)
        starts = np.concatenate([[0], batch.ends[:-1] + 1])
        of_token = batch.by_token(found)
        base = np.log10(known + 1.0) - base_log
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.frombuffer(ids, "<i8")),
                pa.array(batch.trained[batch.ends]),
                pa.array(batch.ends + 1 - starts),
                pa.array(np.add.reduceat(known[batch.row] > 0, starts, dtype=np.int64)),
                pa.array(np.add.reduceat(base[batch.row], starts)),
                pa.array(np.add.reduceat(of_token, starts)),
            ],
            names=["_id", "_train", "n_tokens", "n_known", "base_score", "score"],
        )

    schema = "_id bigint, _train boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored_rows = batches.join(values, F.col("_batch") == F.col("_of")).mapInArrow(score, schema)
    return scored_rows.select(
        F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"),
        (~F.col("_train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(training).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
