"""BPE encoding and decoding with a lexicon of frequent words; other words are merged exactly.

The vocabulary file is one of the tokenizers library: NFC, lower case, words,
digits and runs of marks as pieces, byte-level symbols with a word end, ranked
merges. Its path is a parameter.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulare.llm.lexicon import Lexicon, compile_lexicon
from tabulare.llm.rows import held_by_worker, id_and_bytes, let_go_by_worker, slices, without_collector
from tabulare.session import run_folder, work_table

LEXICON_WORDS = 65_536
CLASSES = 8  # of counts, for each factor of two
CACHE_ENTRIES, CACHE_LETTERS = 500_000, 32_000_000
LEXICON_CACHE_ENTRIES = 200_000  # with a lexicon, which finds the frequent words again, fewer are kept
ENCODED_BYTES = 2_000_000  # of text whose words are held at once where texts are decoded too
MARKS = frozenset(".,;:!?")  # marks that begin no piece with letters
NO_MERGE = 1 << 60
ID_BITS, ID_MASK = 24, (1 << 24) - 1
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 40)  # of the tables in which short pieces are merged side by side; longer ones are not
MERGED_ROWS = 50_000
COUNTED_WORDS = 400_000
ODD_SPACES = re.compile("[\x1c-\x1f]")  # str.split() splits here, the vocabulary's pattern does not
SPACES = regex.compile(r"\p{White_Space}+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Model:
    """The vocabulary, its merges and its way to cut texts into pieces, from the vocabulary file's JSON."""

    def __init__(self, source: bytes) -> None:
        config = json.loads(source)
        model = config["model"]
        cut = config["pre_tokenizer"]["pretokenizers"][0]
        steps = [step["type"] for step in config["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or cut["behavior"] != "Removed" or not cut["invert"]:
            raise ValueError("only vocabularies with NFC, lower case and kept pieces are supported")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        ids = self.vocabulary
        # What two neighbours become: rank and id in one number, so that the smallest is the best.
        self.pairs = {
            ids[a] << ID_BITS | ids[b]: rank << ID_BITS | ids[a + b] for rank, (a, b) in enumerate(model["merges"])
        }
        self.special = {token["content"]: token["id"] for token in config["added_tokens"]}
        self.pieces = regex.compile(cut["pattern"]["Regex"])
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        symbols = byte_symbols()
        self.first_ids = [ids[symbol] for symbol in symbols]
        self.last_ids = {ids[symbol]: ids[symbol + self.suffix] for symbol in symbols}
        size = 1 + max([*self.vocabulary.values(), *self.special.values()])
        self.tokens = [""] * size
        for token, i in chain(self.vocabulary.items(), self.special.items()):
            self.tokens[i] = token

    def segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text between special tokens, normalised, and the special tokens as they are."""
        parts = self.special_split.split(text) if any(name in text for name in self.special) else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield True, part
            elif part:
                # Letters are lowered one by one: no special form of sigma at the end of a word.
                yield False, unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()

    def words(self, text: str) -> list[str]:
        """The parts of a normalised text between white space, with their marks; no piece crosses it."""
        return SPACES.split(text) if ODD_SPACES.search(text) else text.split()

    def cut(self, word: str) -> list[str]:
        """The pieces of a word; one that holds no piece, such as a lone space, has none."""
        if word.isalpha():  # just the letters of the pattern
            return [word]
        if word[-1:] in MARKS and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.pieces.findall(word)

    def merge(self, piece: str) -> list[int]:
        """The ids of one piece by its merges: the best rank first, the leftmost of equal ones.

        Neighbours are linked by number, and a heap holds the possible merges;
        those whose parts have changed since are skipped. The work grows with
        the length times its logarithm, so a piece can be of any length.
        """
        parts = [self.first_ids[b] for b in piece.encode()]
        parts[-1] = self.last_ids[parts[-1]]
        n, find = len(parts), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = [find(a << ID_BITS | b, NO_MERGE) for a, b in zip(parts, parts[1:], strict=False)]
        heap = [(merge, i) for i, merge in enumerate(merges) if merge != NO_MERGE]
        merges.append(NO_MERGE)
        heapify(heap)
        while heap:
            merge, i = heappop(heap)
            if merges[i] != merge:
                continue
            gone = after[i]
            parts[i], parts[gone], merges[gone] = merge & ID_MASK, -1, NO_MERGE
            after[i] = right = after[gone]
            if right < n:
                before[right] = i
            for left in (before[i], i):
                other = after[left] if left >= 0 else n
                if left >= 0:
                    merges[left] = find(parts[left] << ID_BITS | parts[other], NO_MERGE) if other < n else NO_MERGE
                    if merges[left] != NO_MERGE:
                        heappush(heap, (merges[left], left))
        return [part for part in parts if part >= 0]

    @cached_property
    def tables(self) -> tuple[np.ndarray, ...]:
        """The merges as sorted arrays, and what any two bytes, the second of which may end the piece, become."""
        keys = np.array(sorted(self.pairs), np.int64)
        values = np.array([self.pairs[k] for k in keys.tolist()], np.int64)
        first = np.array(self.first_ids, np.int64)
        last = np.array([self.last_ids[i] for i in self.first_ids], np.int64)
        inner, ending = (
            find_merges(keys, values, np.repeat(first, 256), np.tile(second, 256)).reshape(256, 256) for second in (first, last)
        )
        return keys, values, first, last, inner, ending

    def merge_many(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, as 32-bit numbers side by side. Short pieces of alike length are merged together."""
        raw = [piece.encode() for piece in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        found: list[bytes] = [b""] * len(raw)
        for i in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
            found[i] = np.array(self.merge(pieces[i]), np.int32).tobytes()
        for low, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            chosen = np.flatnonzero((sizes > low) & (sizes <= width))
            for start in range(0, len(chosen), MERGED_ROWS):
                at = chosen[start : start + MERGED_ROWS].tolist()
                ids = self._merged([raw[i] for i in at], sizes[at], width)
                ends = (np.cumsum((ids >= 0).sum(1)) * 4).tolist()
                flat = ids[ids >= 0].astype(np.int32).tobytes()
                for i, begin, end in zip(at, [0, *ends], ends, strict=False):
                    found[i] = flat[begin:end]
        return found

    def _merged(self, raw: list[bytes], sizes: np.ndarray, width: int) -> np.ndarray:
        """A row of ids per piece; places that were merged into the one before hold -1."""
        keys, values, first, last, inner, ending = self.tables
        n = len(raw)
        place = np.arange(width)
        letters = np.zeros((n, width), np.uint8)
        letters[place < sizes[:, None]] = np.frombuffer(b"".join(raw), np.uint8)
        ids = np.where(place < sizes[:, None], first[letters], -1)
        ids[np.arange(n), sizes - 1] = last[letters[np.arange(n), sizes - 1]]
        merges = np.full((n, width), NO_MERGE)
        merges[:, :-1] = inner[letters[:, :-1], letters[:, 1:]]
        merges[place >= sizes[:, None] - 1] = NO_MERGE
        several = np.flatnonzero(sizes > 1)
        merges[several, sizes[several] - 2] = ending[letters[several, sizes[several] - 2], letters[several, sizes[several] - 1]]
        after = np.minimum(place + 1, sizes[:, None]).astype(np.int8)
        before = np.tile((place - 1).astype(np.int8), (n, 1))
        rows = np.arange(n)
        while True:
            at = merges[rows].argmin(1)
            best = merges[rows, at]
            open_rows = best != NO_MERGE
            rows, at, best = rows[open_rows], at[open_rows], best[open_rows]
            if not len(rows):
                return ids
            gone = after[rows, at]
            right = after[rows, gone]
            ids[rows, at], ids[rows, gone] = best & ID_MASK, -1
            merges[rows, gone] = merges[rows, at] = NO_MERGE
            after[rows, at] = right
            inside = right < sizes[rows]
            r, i, k = rows[inside], at[inside], right[inside]
            before[r, k] = i
            merges[r, i] = find_merges(keys, values, ids[r, i], ids[r, k])
            left = before[rows, at]
            inside = left >= 0
            r, i, k = rows[inside], left[inside], at[inside]
            merges[r, i] = find_merges(keys, values, ids[r, i], ids[r, k])


def find_merges(keys: np.ndarray, values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What each pair of ids becomes, with its rank, or ``NO_MERGE``."""
    wanted = left << ID_BITS | right
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], NO_MERGE)


class Encoder:
    """Ids by word: looked up in the lexicon, and merged if a word is not there; kept in bounded memory.

    The new words of several texts are looked up together. A special token is
    kept under its name after a blank, which no word holds.
    """

    def __init__(self, model: Model, lexicon: Lexicon | None) -> None:
        self.model, self.lexicon = model, lexicon
        self.special_names = {f" {name}" for name in model.special}
        self._forget()

    def _forget(self) -> None:
        self.letters, self.ids = 0, {}

    def words(self, text: str) -> list[str]:
        found: list[str] = []
        for is_special, part in self.model.segments(text):
            if is_special:
                found.append(f" {part}")
            else:
                found += self.model.words(part)
        return found

    def learn(self, texts: list[list[str]]) -> None:
        """Look up the words of these texts that are not known."""
        with without_collector():
            self._learn(texts)

    def _learn(self, texts: list[list[str]]) -> None:
        most = min(CACHE_ENTRIES, LEXICON_CACHE_ENTRIES) if self.lexicon else CACHE_ENTRIES
        if len(self.ids) > most or self.letters > CACHE_LETTERS:  # what is dropped is looked up again
            self._forget()
        known, special = self.ids, self.model.special
        fresh = set().union(*texts).difference(known)
        self.letters += sum(map(len, fresh))
        known.update((name, np.array([special[name[1:]]], np.int32).tobytes()) for name in self.special_names & fresh)
        if self.lexicon:
            asked = list(fresh)
            ids = self.lexicon.find_many([word.encode() for word in asked])
            known.update((word, found) for word, found in zip(asked, ids, strict=True) if found is not None)
        if self.lexicon or not self.special_names.isdisjoint(fresh):
            fresh = fresh.difference(known)
        letters = set(filter(str.isalpha, fresh))  # a piece each, as the pattern takes just letters
        mixed = list(fresh.difference(letters))
        cut = list(map(self.model.cut, mixed))
        pieces = list(letters.union(*cut).difference(known))
        known.update(zip(pieces, self.model.merge_many(pieces), strict=True))
        find = known.__getitem__
        known.update((word, b"".join(map(find, parts))) for word, parts in zip(mixed, cut, strict=True))

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[list[str]]]:
        """Per text its ids, as 32-bit numbers side by side, and its words, for ``decode``."""
        cut = list(map(self.words, texts))
        self.learn(cut)
        find = self.ids.__getitem__
        return [b"".join(map(find, words)) for words in cut], cut

    def decode(self, words: list[str]) -> str:
        """The tokens of the words with a blank between: the vocabulary file names no decoder."""
        return self.decode_ids(b"".join(map(self.ids.__getitem__, words)))

    def decode_ids(self, ids: bytes) -> str:
        """The same from the ids of a text; decoded words are not kept, as their tokens are all there."""
        return " ".join(map(self.model.tokens.__getitem__, memoryview(ids).cast("i")))


def shared_encoder(source: bytes, lexicon: str | None) -> Encoder:
    """The encoder of this Python worker: its tasks, one after the other, share what it has looked up."""
    return held_by_worker(
        "encoder", (hash(source), lexicon), lambda: Encoder(Model(source), Lexicon(SparkFiles.get(lexicon)) if lexicon else None)
    )


def word_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """How often each normalised word, up to white space, occurs in all texts. Each task sums what it reads before the shuffle, in bounded memory."""
    source = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_by_worker("encoder")  # of another run; this one's lexicon is still to be made
        model, seen = Model(source.value), Counter()

        def counted() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict(
                {"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())}
            )
            seen.clear()
            return batch

        for part in slices(batches):
            for raw in part.column("_text"):
                for is_special, segment in model.segments(raw.as_py().decode()):
                    if not is_special:
                        seen.update(model.words(segment))
            if len(seen) > COUNTED_WORDS:
                yield counted()
        yield counted()

    return (
        id_and_bytes(docs, key, text)
        .mapInArrow(count, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def build_lexicon(
    docs: DataFrame, vocabulary: str, size: int = LEXICON_WORDS, key: str = "doc_id", text: str = "text"
) -> str:
    """Compile the most frequent words of all texts; returns the name under which tasks find the file.

    The counts cover every text. They are counted by size class first, which
    tells from which class on there are at most ``size`` words, a parameter:
    no more come to the driver. The file goes to the shared folder, from which
    Spark hands a copy to each executor.
    """
    spark = docs.sparkSession
    model = Model(_read(vocabulary))
    counted = word_counts(docs, vocabulary, key, text).where("n > 1")
    counts = work_table(counted.withColumn("class", F.floor(F.log2("n") * CLASSES).cast("int")), "words")
    room, least = size, 64 * CLASSES
    for row in counts.groupBy("class").count().orderBy(F.col("class").desc()).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["class"]
    top = counts.where(F.col("class") >= least).select("word").collect()
    cut = [model.cut(row.word) for row in top]
    pieces = list(set(chain.from_iterable(cut)))
    merged = dict(zip(pieces, model.merge_many(pieces), strict=True))
    entries = {row.word.encode(): b"".join(map(merged.__getitem__, parts)) for row, parts in zip(top, cut, strict=True)}
    compiled = compile_lexicon({word: np.frombuffer(ids, np.int32).tolist() for word, ids in entries.items()})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{run_folder(spark, 'lexicon')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(compiled))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def encode_decode(
    docs: DataFrame,
    vocabulary: str,
    lexicon: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``doc_id``, its token ``ids``, the ``decoded`` text of those ids, and the ``carried`` columns.

    A null or empty text has no ids and decodes to nothing; repeated rows and
    null keys are encoded like any other row; an empty table gives no rows.
    ``lexicon`` is the name that ``build_lexicon`` returned. No shuffle.
    """
    source = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(source.value, lexicon)
        for part in slices(batches, most=ENCODED_BYTES):
            encoded, _ = encoder.encode([str(raw.as_buffer(), "utf-8") if raw.is_valid else "" for raw in part.column("_text")])
            offsets = np.cumsum([0, *map(len, encoded)]) // 4
            flat = pa.array(np.frombuffer(b"".join(encoded), np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                    pa.array(list(map(encoder.decode_ids, encoded)), pa.string()),
                    *(part.column(f"_c{i}") for i in range(len(carried))),
                ],
                names=["doc_id", "ids", "decoded", *carried],
            )

    rows = docs.select(
        F.col(key).cast("bigint").alias("_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
        *(F.col(name).alias(f"_c{i}") for i, name in enumerate(carried)),
    )
    schema = T.StructType.fromDDL("doc_id bigint, ids array<int>, decoded string")
    for name in carried:
        schema.add(name, docs.schema[name].dataType)
    return rows.mapInArrow(run, schema)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
