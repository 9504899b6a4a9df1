"""Spelling variants grouped by a bit-sliced position index.

1. *Vocabulary.* Tasks count the words of their documents in bounded tables; counts are summed.
2. *Blocks.* Two words that differ by one inserted, deleted or replaced letter agree before and
   after the place where they first differ. With ``s`` letters in the shorter one, that place
   lies in one of the gaps that ``[0, s]`` is cut into, and both words have the same letters
   before the gap and the same after it. Gap, letters before and letters after are a block's
   key; every word has a key per gap, once as the shorter and once as the longer of a pair. Gaps
   are halves of the word first. Blocks of more than ``BLOCK_WORDS`` words have their gap halved
   again, and so on to a gap of one letter, whose blocks are bounded by the square of the
   alphabet: no block grows with the vocabulary.
3. *Index.* In a block, for every position of the gap and every letter, a bitset says which
   words have that letter there. A word's letters run through it once. ``zero`` are the words
   that agree so far; those that fall out of it at a letter go on in three one-error sets, read
   at the same position (a replaced letter), one position on (a letter the other word has more)
   or one back (a letter it has less). All words of the block are treated by one operation on
   the whole bitset. As an error is taken only where a word falls out, each pair is met in
   one block.
4. *Forms.* Blocks send, per word, how many words are near and the best of them, no pairs.
   Forms are followed to their end by doubling: counts grow fivefold along them, so a few rounds
   reach it.

Words are maximal runs of ASCII letters and U+00C0 to U+00FF, of which A to Z are lower-cased.

Cases: null and empty texts have no words; a null id is read as an empty text where ids take
part in ``damaged``; repeated rows count each; an empty table, or one without frequent words, gives
no rows; a text or word of any length is read in whole; of near words of equal count the smallest in
code-point order is the form; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import for_python, text_of, written

LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
# Words of a block whose gap isn't halved again, and words a task counts before it sends them.
BLOCK_WORDS, COUNTED = 4096, 1 << 18
# Fixed by the contract: one word in so many loses a letter.
DAMAGE = 199
# Every character of a word is one byte of Latin-1; upper-case ASCII becomes lower-case, all others part words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    """The words of a text, in Latin-1: a byte per letter."""
    # What Latin-1 doesn't have becomes a question mark, which is no letter.
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def damaged(word: bytes, crc: int) -> bytes:
    """The word, in one case of ``DAMAGE`` by the checksum of ``<doc_id>:<word>`` without one letter."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), crc)
    if h % DAMAGE:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _counted(batches):
    held: Counter[bytes] = Counter()

    def sent():
        out = pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in held], pa.string()), "n": pa.array(held.values(), pa.int64())})
        held.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
            # Shorter words stay short, whatever happens to them.
            found = Counter(w for w in words(text.as_py()) if len(w) >= LEAST_LETTERS)
            crc = zlib.crc32(f"{doc}:".encode())
            for word, n in found.items():
                held[damaged(word, crc)] += n
            if len(held) >= COUNTED:
                yield sent()
    yield sent()


def vocabulary(documents: DataFrame) -> DataFrame:
    """word and n, of words that are long and frequent enough."""
    docs = for_python(documents).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), text_of().alias("text"))
    counts = docs.mapInArrow(_counted, "word string, n long").where(F.char_length("word") >= LEAST_LETTERS)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _keyed(frame: DataFrame) -> DataFrame:
    """Entries with their block's key: size of the shorter word, gap, and the letters before and after it."""
    return frame.withColumn("key", F.concat_ws(":", "s", "a", "b", F.expr("left(word, a)"), F.expr("right(word, s - b)")))


def _cut(frame: DataFrame, gaps: list[tuple]) -> DataFrame:
    """Entries once per gap."""
    gap = F.explode(F.array(*(F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")) for a, b in gaps)))
    return _keyed(frame.select("word", "n", "s", gap.alias("gap")).select("word", "n", "s", "gap.a", "gap.b"))


def blocks(words: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """Entries (word, n, s, a, b, key), of blocks of at most ``most`` words but for gaps of one letter.

    A word is the shorter one of a pair, or as long, where it has ``s`` letters; else the longer one.
    """
    length = F.char_length("word")
    sized = words.withColumn("s", F.explode(F.array(length, length - 1))).where("s > 1")
    half = F.expr("s div 2")
    left, done = written(_cut(sized, [(F.lit(0), half), (half, F.col("s"))]), "spelling"), []
    while True:
        sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.first("a").alias("a"), F.first("b").alias("b"))
        large = written(sizes.where((F.col("size") > most) & (F.col("b") - F.col("a") > 1)).select("key"), "spelling")
        if large.isEmpty():
            break
        done.append(left.join(large, "key", "left_anti").select("word", "n", "s", "a", "b", "key"))
        mid = F.expr("(a + b) div 2")
        left = written(_cut(left.join(large, "key", "left_semi"), [(F.col("a"), mid), (mid, F.col("b"))]), "spelling")
    for more in done:
        left = left.unionByName(more)
    return left


class Index:
    """Bitsets over the words of a block: by position in the gap and letter, and by length.

    ``parts`` are what words have between the letters all have in common: ``gap`` letters, or one more.
    ``last``: nothing follows the gap.
    """

    def __init__(self, parts: list[str], gap: int, last: bool):
        self.gap, self.last, self.all = gap, last, (1 << len(parts)) - 1
        self.at: dict[tuple[int, str], int] = {}
        self.longer = 0
        for i, part in enumerate(parts):
            bit = 1 << i
            if len(part) > gap:
                self.longer |= bit
            for place in enumerate(part):
                self.at[place] = self.at.get(place, 0) | bit
        self.shorter = self.all & ~self.longer

    def near(self, part: str) -> int:
        """The words one letter from a word with this part, first differing within the gap.

        Pairs of words that both have a letter more than the gap belong to other blocks.
        """
        at, gap = self.at.get, self.gap
        zero, replaced, shifted = self.all, 0, 0
        if len(part) > gap:
            for j in range(gap):
                letter = part[j]
                here = at((j, letter), 0)
                # The others lack a letter: what follows stands one position back in them.
                shifted = shifted & at((j - 1, letter), 0) | zero & ~here & self.shorter
                zero &= here
            shifted &= at((gap - 1, part[gap]), 0)
            return shifted | (zero & self.shorter if self.last else 0)
        for j in range(gap):
            letter = part[j]
            here = at((j, letter), 0)
            fallen = zero & ~here
            replaced = replaced & here | fallen & self.shorter
            # The others have a letter more: this one and what follows stand one position on.
            shifted = (shifted | fallen & self.longer) & at((j + 1, letter), 0)
            zero &= here
        return replaced | shifted | (zero & self.longer if self.last else 0)


def near_in_block(words: list[tuple[str, int]], s: int, a: int, b: int) -> list[tuple[str, int, int, str]]:
    """word, number of near words in the block, count of the best one and that word."""
    # In this order the lowest bit of a set is its most frequent word, ties by code points.
    words = sorted(words, key=lambda w: (-w[1], w[0]))
    parts = [w[a : len(w) - (s - b)] for w, _ in words]
    index, out = Index(parts, b - a, b == s), []
    if not index.shorter:
        return out
    for (word, _), part in zip(words, parts):
        found = index.near(part)
        if found:
            best, n = words[(found & -found).bit_length() - 1]
            out.append((word, found.bit_count(), n, best))
    return out


def _blockwise(batches):
    """Runs of rows of one key, as blocks."""
    key, held, place = None, [], None
    out: list[tuple] = []

    def sent():
        columns = list(zip(*out)) or [()] * 4
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "k", "best_n", "best"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "word", "n", "s", "a", "b"))
        for new, word, n, *where in zip(*columns):
            if new != key:
                if len(held) > 1:
                    out += near_in_block(held, *place)
                key, held, place = new, [], where
            held.append((word, n))
        if len(out) > 10_000:
            yield sent()
    if len(held) > 1:
        out += near_in_block(held, *place)
    yield sent()


def near_words(words: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """word, n_near, best_n and best, of the words (word, n) that any other is near to."""
    dealt = blocks(words, most).repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(_blockwise, "word string, k long, best_n long, best string")
    # The least of (-n, word) is the most frequent, ties by code points.
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("k").alias("n_near"), best).select("word", "n_near", (-F.col("b.m")).alias("best_n"), "b.best")


def _roots(links: DataFrame) -> DataFrame:
    """word and root, from (word, form) without circles: both ends of each link move on by doubling."""
    ends = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(ends.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        ends = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ends


def variants(documents: DataFrame, most: int = BLOCK_WORDS, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of the corpus' vocabulary."""
    words = written(vocabulary(documents), "vocabulary")
    own = words.join(near_words(words, most), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    own = written(
        own.select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(own.where("form is not null"))
    return own.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
