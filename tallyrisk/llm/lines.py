"""Line dedup: fuzzy lines by SimHash and MinHash blocks, linked by edit similarity alone.

Lines are normalised (lower case, punctuation around words and extra white
space gone).  Equal normalised lines are one node from the start.
Two lines are linked when their edit similarity (1 - Levenshtein distance /
longer length, on the normalised lines) is at least the threshold.  Two
searches find the candidates, and only them:

- a 64-bit SimHash of the words, weighted by their length: two lines within
  three bits share one of four 16-bit blocks, so lines are joined on blocks.  A
  block shared by too many lines is split by the next pigeonhole: the other 48
  bits make four parts of which one must agree as well;
- 32 minima over the set of words (MinHash; long words are proportionally likelier
  to be one, so that a word counts by its characters, as in the edit distance), a
  byte each: lines are joined on groups of three, those of few words on groups of
  two as well, and compared by how many of the 32 agree in half a byte.

Lines whose lengths alone exclude the similarity are never candidates: a cell is
sorted by length, and a line is compared as far as its length allows.
Cells that stay too large for one task are cut into pieces, and every two
pieces meet in one task, so each pair of lines is still compared.

Candidates that hang together are confirmed together, each line's text being
sent once.  Chains of more than COMPONENT lines are confirmed cell by cell
instead: of a cell, the lines that hang together within it; cells with the same
such lines count once.

Of each connected group the first occurrence, by
(doc_id, line), is kept.

Scale.  Repeats are combined map-side before anything is joined, so a line
that stands in a third of all documents is one node.  Cells travel packed, a
few rows of many cells each; lines alone in their cell are dropped at once.  Inside
a cell, bits are compared in whole columns; only nodes with a partner leave it, as
spanning edges.  Edit distances of many pairs are taken together.  Line texts are fetched for those nodes alone, and meet once for each
candidate group.  Decisions go back to documents as lists of line numbers.
The lists of wanted and of dropped lines grow with the documents, so they are
shuffled with these and never broadcast: one plan at every size, which costs small
tables two shuffles of their texts.

Defined cases: null texts have no lines and stay null; lines of fewer than
``min_words`` words and fewer than MIN_CHARS characters, blank ones included, are always kept; rows equal in id and
text are one document and treated alike; other columns are untouched; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Words, flat_array, groups, hash_strings, mix64, ship_package, slices, stored, unsliced
from .components import connected_components
from .decontamination import PUNCTUATION
from .linking import small, spanning_links, units

#: Bits of the SimHashes in which linked lines may differ: any, edit similarity alone decides.
BITS = 64
#: Bits in which candidates found by blocks of the SimHash differ at most; four blocks find all of these.
BLOCK_BITS = 3
#: Minima of a line; those that agree (in four bits, by chance one in 16) in candidates found by groups of them.
MINIMA = 32
AGREEING = 12
TRIPLES = [(3 * k, 3 * k + 1, 3 * k + 2) for k in range(10)] + [(30, 0, 10), (31, 5, 15)]
#: Words up to which a line is also found by pairs of minima: there one changed word is a large share of it.
SHORT = 16
PAIRS = [(2 * k, 2 * k + 1) for k in range(MINIMA // 2)]
SIMILARITY = 0.8
MIN_WORDS = 5
#: Characters from which a line of fewer words takes part too (scripts without spaces).
MIN_CHARS = 40
#: Lines of one block that are compared together; more split it, and above PART cut it into pieces, see above.
CROWD = 2000
PART = 20_000
SLOTS = 1 << 18
BLOCKS = 4 << 16
COMPONENT = 20_000
#: Characters after which two texts count as going on alike.
SYNC = 12
#: Pairs whose edit distances are taken together at most, and the words of 64 bits of the tables of where their letters
#: stand; as many words as their bits are taken in; fewer than ALONE a word and pairs that need more go one by one.
TOGETHER = 2048
TABLE_WORDS = 1 << 20
ALONE = 32
WORDS = (1, 2, 4)
#: Codes of the commonest characters of such pairs, and those that the others share.
OWN_CODES = 96
SHARED_CODES = 32
#: Pairs of lines that are decided at once, first and later on; lines that hang together by then are not compared any more.
PENDING = (1000, 16_000)


def normalised(lines: pa.Array) -> pa.Array:
    """The lines in lower case, one space between words, without punctuation around these."""
    words = Words(lines, lower=False)
    vocabulary = pc.utf8_lower(pc.ascii_trim(words.vocabulary, characters=PUNCTUATION))
    kept = (pc.binary_length(vocabulary).to_numpy(zero_copy_only=False) > 0)[words.codes] if len(words.codes) else np.empty(0, bool)
    bounds = np.concatenate([[0], np.cumsum(kept)])[words.bounds]
    lists = pa.LargeListArray.from_arrays(pa.array(bounds), vocabulary.take(pa.array(words.codes[kept])))
    return pc.binary_join(lists, pa.scalar(" ", lists.type.value_type))


class Lines:
    """The lines of a batch of texts with at least ``min_words`` words or MIN_CHARS characters: owner text, number, words."""

    def __init__(self, texts: pa.Array, min_words: int):
        parts = pc.split_pattern(pc.fill_null(unsliced(texts).cast(pa.large_string()), ""), "\n")
        number = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        self.total = number
        owner = np.repeat(np.arange(len(texts)), number)
        place = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        flat = parts.flatten()
        words = Words(flat, lower=False)
        vocabulary = pc.utf8_lower(pc.ascii_trim(words.vocabulary, characters=PUNCTUATION))
        real = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False) > 0
        kept = real[words.codes] if len(words.codes) else np.empty(0, bool)
        bounds = np.concatenate([[0], np.cumsum(kept)])[words.bounds]
        codes = words.codes[kept]
        chars = np.concatenate([[0], np.cumsum(pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False)[codes])])[bounds]
        enough = np.flatnonzero((np.diff(bounds) >= min_words) | (np.diff(chars) >= MIN_CHARS))
        self.owner, self.place = owner[enough], place[enough]
        self.vocabulary = vocabulary
        sizes = np.diff(bounds)[enough]
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(bounds[:-1][enough] - self.bounds[:-1], sizes) + np.arange(sizes.sum())
        self.codes = codes[at]
        #: Characters of each normalised line, the spaces between its words included.
        self.chars = np.diff(chars)[enough] + np.maximum(sizes - 1, 0)

    def keys(self) -> list[bytes]:
        """A 128-bit hash of each normalised line."""
        return _binary(self.key_bytes(), 16).to_pylist()

    def key_bytes(self) -> bytes:
        h = hash_strings(self.vocabulary, 23)[self.codes]
        sizes = np.diff(self.bounds)
        if not len(sizes):
            return b""
        place = (np.arange(len(h)) - np.repeat(self.bounds[:-1], sizes)).astype(np.uint64)
        a = np.add.reduceat(mix64(h + mix64(place + np.uint64(1))), self.bounds[:-1])
        b = np.add.reduceat(mix64(h ^ mix64(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7))), self.bounds[:-1])
        key = np.stack([mix64(a + sizes.astype(np.uint64)), mix64(b ^ mix64(a))], axis=1).astype(">u8")
        return key.tobytes()

    def simhashes(self) -> np.ndarray:
        """64 bits: each the sign of the sum over the line's words, weighted by length."""
        h = hash_strings(self.vocabulary, 29)
        weight = np.minimum(pc.utf8_length(self.vocabulary).to_numpy(zero_copy_only=False), 30).astype(np.uint64)
        out = np.zeros(len(self.bounds) - 1, np.uint64)
        if not len(out):
            return out
        starts = self.bounds[:-1]
        total = np.add.reduceat(weight[self.codes], starts)
        width = 16 if int(total.max()) < 1 << 16 else 32  # four or two bits at a time, in the parts of a word
        parts = range(0, 64, width)
        ones, low = np.uint64(sum(1 << p for p in parts)), np.uint64((1 << width) - 1)
        for k in range(width):
            sums = np.add.reduceat(((h >> np.uint64(k) & ones) * weight).take(self.codes), starts)
            for p in parts:
                out |= (2 * (sums >> np.uint64(p) & low) > total).astype(np.uint64) << np.uint64(k + p)
        return out

    def minima(self) -> np.ndarray:
        """MINIMA bytes a line: hashes of the least of its words in as many orders, in each of which a word is first
        with a probability proportional to its length."""
        out = np.zeros((len(self.bounds) - 1, MINIMA), np.uint8)
        if not len(out):
            return out
        h = hash_strings(self.vocabulary, 31)
        weight = 1.0 + np.minimum(pc.utf8_length(self.vocabulary).to_numpy(zero_copy_only=False), 30)
        place = np.empty(len(h), np.float32)
        for k in range(MINIMA):
            for at in range(0, len(h), 8192):  # a piece of the vocabulary stays in the cache
                even = (mix64(h[at:at + 8192] + np.uint64(7919 * k + 1)) >> np.uint64(11)).view(np.int64).astype(np.float64)
                even += 0.5
                even /= 2.0 ** 53
                np.log(even, out=even)
                np.negative(even, out=even)
                even /= weight[at:at + 8192]
                place[at:at + 8192] = even
            least = np.minimum.reduceat(place.take(self.codes), self.bounds[:-1])
            out[:, k] = mix64(least.view(np.uint32).astype(np.uint64)) & np.uint64(255)
        return out

    def text(self, i: int) -> str:
        return " ".join(self.vocabulary.take(pa.array(self.codes[self.bounds[i]:self.bounds[i + 1]])).to_pylist())


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance by bit vectors (one column of the table is one integer); with ``most``, some value above it
    as soon as that is exceeded.

    Only the diagonals that ``most`` edits can reach are kept; the value on the last cell's diagonal never falls."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if len(a) < len(b):
        a, b = b, a
    distance = len(a) - len(b)
    if not b:
        return distance
    most = len(a) if most is None else most
    if distance > most:
        return distance
    slack = (most - distance) // 2
    masks: dict[str, int] = {}
    bit = 1 << slack
    for c in a:
        masks[c] = masks.get(c, 0) | bit
        bit <<= 1
    full, target = (1 << distance + 2 * slack + 1) - 1, 1 << distance + slack
    up, down = full >> slack << slack, 0
    for j, c in enumerate(b):
        eq = masks.get(c, 0) >> j & full
        same = (((eq & up) + up) ^ up | eq | down) & full
        if not same & target:
            distance += 1
            if distance > most:
                return distance
        right = down | (same | up) ^ full
        left = same & up
        same >>= 1
        down = same & right
        up = left | (same | right) ^ full
    return distance


def alignment_cost(a: str, b: str, most: int) -> int:
    """Edits of one way to turn ``a`` into ``b``, so at least their edit distance; above ``most`` it gives up.

    Equal runs are skipped; after a difference, the next SYNC characters of ``a`` that follow near in ``b`` go on."""
    i = j = cost = 0
    while cost <= most:
        room = min(len(a) - i, len(b) - j)
        run, step = 0, 32
        while step:  # doubled while equal, halved after
            if run + step <= room and a[i + run:i + run + step] == b[j + run:j + run + step]:
                run += step
                step *= 2
            else:
                step //= 2
                while step and run + step > room:
                    step //= 2
        i, j = i + run, j + run
        if i == len(a) or j == len(b):
            break
        for skip in range(min(most - cost, len(a) - i - SYNC) + 1):
            at = b.find(a[i + skip:i + skip + SYNC], j, j + most - cost + SYNC)
            if at >= 0:
                cost += edit_distance(a[i:i + skip], b[j:at])
                i, j = i + skip, at
                break
        else:
            break
    return cost + max(len(a) - i, len(b) - j)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _coded(verticals: list[np.ndarray], horizontals: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Codes of all characters, those of the first texts and then the others', their number, and which first texts have
    characters that share a code (the common ones have one of their own); 0 stands for characters of no first text."""
    first, second = np.concatenate(verticals), np.concatenate(horizontals)
    counts = np.bincount(first, minlength=1)
    letters = np.flatnonzero(counts)
    letters = letters[np.argsort(-counts[letters], kind="stable")]
    code = np.zeros(max(len(counts), int(second.max(initial=0)) + 1), np.int64)
    place = np.arange(len(letters))
    code[letters] = np.where(place < OWN_CODES, place, OWN_CODES + place % SHARED_CODES) + 1
    codes = code[first]
    bounds = np.cumsum([0, *(len(v) for v in verticals)])
    shared = np.concatenate([[0], np.cumsum(codes > OWN_CODES)])[bounds]
    return codes, code[second], int(codes.max(initial=0)) + 1, np.diff(shared) > 0


def _few_edits(verticals: list[np.ndarray], horizontals: list[np.ndarray], limits: np.ndarray, words: int) -> np.ndarray:
    """Which pairs are at most so many edits apart, first texts being the longer ones: all tables at once, by bit vectors.

    A path of k edits between lengths that differ by D leaves the diagonals between start and end by (k - D) / 2 at most, so
    64 bits a word hold the k + 1 diagonals (Hyyro's band of Myers's vectors).  The value on the last cell's diagonal never
    falls, so a pair goes as soon as it exceeds the limit there.  Both texts go on alike behind their ends."""
    m, n = np.array([len(v) for v in verticals]), np.array([len(h) for h in horizontals])
    number, u = len(m), np.uint64
    slack = (limits - (m - n)) // 2
    first, second, letters, shared = _coded(verticals, horizontals)
    end, letters = letters, letters + 1
    columns = int(n.max()) // 32 * 32 + 32
    height = max(int((m + slack).max()), columns) // 64 + words + 2
    # table[q, pair and letter]: where the letter stands, 64 rows a word, row 0 of every pair at its slack.
    pair = np.repeat(np.arange(number), m)
    row = np.arange(len(first)) - np.repeat(np.cumsum(m) - m, m) + slack[pair]
    at = ((row >> 6) * (number * letters) + pair * letters + first) * 2 + (row >> 5 & 1)
    table = np.bincount(at, weights=(1 << (row & 31)).astype(np.float64), minlength=height * number * letters * 2)
    table = table.astype(np.uint32).view(u).reshape(height, number * letters)

    def from_row(rows: np.ndarray, count: int) -> np.ndarray:  # words with all bits from these rows on
        shift = rows[None, :] - 64 * np.arange(count)[:, None]
        bits = u(0xFFFFFFFFFFFFFFFF) << np.clip(shift, 0, 63).astype(u)
        return np.where(shift >= 64, u(0), bits)

    table[:, end::letters] = from_row(m + slack, height)
    text = np.full((number, columns), end, np.int64)
    owner = np.repeat(np.arange(number), n)
    text[owner, np.arange(len(second)) - np.repeat(np.cumsum(n) - n, n)] = second
    text = np.ascontiguousarray(text.T)

    up, down = from_row(slack, words), np.zeros((words, number), u)
    target = (m - n + slack)
    word, bit = target >> 6, (target & 63).astype(u)
    lanes, base, ids = np.arange(number), np.arange(number) * letters, np.arange(number)
    score, most, last = m - n, limits, n
    out = np.zeros(number, bool)
    one, top, gone = u(1), u(63), 0
    for j in range(columns):
        if j % 16 == 0:
            stay = (score <= most) & (last > j)
            kept = np.flatnonzero(stay)
            out[ids[(score <= most) & (last <= j)]] = True
            if not len(kept):
                break
            if len(kept) <= 0.8 * len(ids):
                up, down, text, score, most, last, word, bit, base, ids = (
                    up[:, kept], down[:, kept], text[j - gone:, kept], score[kept], most[kept], last[kept], word[kept], bit[kept],
                    base[kept], ids[kept])
                lanes, gone = np.arange(len(ids)), j
        q, o = j >> 6, j & 63
        place = base + text[j - gone]
        rows = table[q:q + words + 1].take(place, axis=1)
        eq = (rows[:-1] >> u(o)) | (rows[1:] << u(64 - o)) if o else rows[:-1]
        total = eq & up
        if words == 1:
            total += up
        else:
            carry = None
            for w in range(words):
                part = total[w]
                part += up[w]
                over = part < up[w]
                if carry is not None:
                    part += carry
                    over |= part < carry
                carry = over.astype(u)
        total ^= up
        total |= eq
        total |= down  # 1: the same value as one row and column before
        here = total[0] if words == 1 else total[word, lanes]
        score = score + (((here >> bit) & one) ^ one).view(np.int64)
        right = down | ~(total | up)
        left = total & up
        moved = total >> one
        if words > 1:
            moved[:-1] |= total[1:] << top
        down = moved & right
        up = left | ~(moved | right)
    else:
        out[ids[score <= most]] = True
    return _sure(out, shared, verticals, horizontals, limits)


def _sure(out: np.ndarray, shared: np.ndarray, verticals: list[np.ndarray], horizontals: list[np.ndarray],
          limits: np.ndarray) -> np.ndarray:
    """Pairs found with shared codes are decided on their own: two characters of a code passed for one."""
    for k in np.flatnonzero(out & shared):
        a, b = (x[k].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") for x in (verticals, horizontals))
        out[k] = alignment_cost(a, b, int(limits[k])) <= limits[k] or edit_distance(a, b, int(limits[k])) <= limits[k]
    return out


def few_edits(first: list[str], second: list[str], limits: np.ndarray) -> np.ndarray:
    """Which pairs of texts are at most so many edits apart: those of like length together, few and long ones one by one."""
    size_a, size_b = np.array([len(x) for x in first], np.int64), np.array([len(x) for x in second], np.int64)
    longer, shorter = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    out = np.zeros(len(first), bool)
    words = limits // 64 + 1
    able = limits >= longer - shorter
    for w in WORDS:
        some = np.flatnonzero(able & (words > 0) & (words <= w))
        words[some] = 0
        some = some[np.argsort(shorter[some], kind="stable")]
        step = max(64, min(TOGETHER, TABLE_WORDS // (48 * (int(longer[some].max(initial=0)) * 5 // 256 + w + 3))))
        for low in range(0, len(some), step):
            part = some[low:low + step]
            if len(part) < ALONE * w:
                words[part] = w + 1  # with those of the next width, or alone
                continue
            long = [code_points(first[k] if size_a[k] >= size_b[k] else second[k]) for k in part]
            short = [code_points(second[k] if size_a[k] >= size_b[k] else first[k]) for k in part]
            out[part] = _few_edits(long, short, limits[part], w)
    for k in np.flatnonzero(able & (words > 0)):
        most = int(limits[k])
        out[k] = alignment_cost(first[k], second[k], most) <= most or edit_distance(first[k], second[k], most) <= most
    return out


def within(a: np.ndarray, others: list[np.ndarray], limits: np.ndarray) -> np.ndarray:
    """Which of ``others`` are at most so many edits from ``a`` (code points)."""
    text, *rest = (x.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") for x in [a, *others])
    return few_edits([text] * len(rest), rest, np.asarray(limits, np.int64))


def bigrams(text: str) -> np.ndarray:
    """Counts of the text's character pairs in 256 buckets."""
    return bigram_counts([text])[0]


def bigram_counts(texts: list[str]) -> np.ndarray:
    """The bigrams of each text, a row a text."""
    out = np.zeros((len(texts), 256), np.int32)
    for low in range(0, len(texts), 500):
        part = texts[low:low + 500]
        x = code_points("".join(part))
        owner = np.repeat(np.arange(len(part)), [len(t) for t in part])
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        bucket = ((x[inside] * np.uint32(31) + x[inside + 1]) * np.uint32(0x9E3779B1)) >> np.uint32(24)
        out[low:low + 500] = np.bincount(owner[inside] * 256 + bucket, minlength=256 * len(part)).reshape(-1, 256)
    return out


def may_be_similar(shared: np.ndarray, longer: np.ndarray, least: float) -> np.ndarray:
    """Whether texts with so many pairs of characters in common can be that similar: an edit takes two pairs away at most
    (buckets that several pairs share only add to ``shared``)."""
    return shared >= longer - 1 - 2 * np.floor((1 - least) * longer + 1e-9)


def lengths_allow(shorter: np.ndarray, longer: np.ndarray, least: float) -> np.ndarray:
    """Whether texts of such lengths can be that similar: an edit changes the length by one at most."""
    return shorter >= least * longer


def similar(a: str, b: str, least: float) -> bool:
    longer = max(len(a), len(b))
    most = (1 - least) * longer + 1e-9
    return bool(lengths_allow(min(len(a), len(b)), longer, least)) and (
        alignment_cost(a, b, int(most)) <= most or edit_distance(a, b, int(most)) <= most)


def _occurrences(batches: Iterator[pa.RecordBatch], min_words: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1000):
        lines = Lines(batch.column(2), min_words)
        at = pa.array(lines.owner)
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(at), batch.column(1).take(at), pa.array(lines.place.astype(np.int32)),
            _binary(lines.key_bytes(), 16), pa.array(lines.simhashes().view(np.int64)),
            _binary(lines.minima().tobytes(), MINIMA),
            pa.array(np.diff(lines.bounds).astype(np.int32)), pa.array(lines.chars.astype(np.int32))], schema=schema)


def _cells(nodes: DataFrame, blocks_of: np.ndarray | None = None) -> DataFrame:
    """(region, and the columns of ``nodes``: node, simhash, ...): lines that share a 16-bit block; crowded blocks split by the rest's 12-bit parts.
    With ``blocks_of``, the crowded blocks, the cells of these alone."""
    h = F.col("simhash")

    def bits(value: Column, low: int, count: int) -> Column:
        return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << count) - 1)) if low < 64 else F.lit(0).cast("long")

    def rest(i: int) -> Column:
        below = bits(h, 0, 16 * i) if i else F.lit(0).cast("long")
        above = F.shiftrightunsigned(h, 16 * (i + 1)) if i < 3 else F.lit(0).cast("long")
        return below.bitwiseOR(F.shiftleft(above, 16 * i))

    blocks = F.array(*[F.struct((bits(h, 16 * i, 16) + F.lit(i << 16)).alias("region"), rest(i).alias("rest"))
                       for i in range(4)])
    names = nodes.columns
    rows = nodes.select(*names, F.explode(blocks).alias("block")).select(*names, "block.*")
    if blocks_of is None:
        sizes = rows.groupBy("region").agg(F.count("*").alias("n"))  # 4 * 65,536 keys at most
        crowded = stored(sizes.filter(F.col("n") > CROWD).select("region"), "crowded")
        if crowded.isEmpty():
            return rows.select("region", *names)
    else:
        crowded = nodes.sparkSession.createDataFrame([(int(r),) for r in blocks_of], "region long")
    parts = F.array(*[F.struct(F.lit(k).alias("part"), bits(F.col("rest"), 12 * k, 12).alias("value")) for k in range(4)])
    fine = rows.join(F.broadcast(crowded), "region").select("region", *names, F.explode(parts).alias("p"))
    fine = stored(fine.select(F.xxhash64("region", "p.part", "p.value").alias("region"), *names), "parts")
    if blocks_of is not None:
        return _met(fine)
    calm = rows.join(F.broadcast(crowded), "region", "left_anti").select("region", *names)
    return calm.unionByName(_met(fine))


def _met(cells: DataFrame) -> DataFrame:
    """The same cells (region, node, ...), those of more than PART lines as pieces, of which every two share a cell."""
    # Counted first by a part of the key, which is combined map-side.
    slot = F.pmod(F.xxhash64("region"), F.lit(SLOTS)).alias("slot")
    full = stored(cells.groupBy(slot).agg(F.count("*").alias("n")).filter(F.col("n") > PART).select("slot"), "full")
    if full.isEmpty():
        return cells
    within = cells.select("region", slot).join(small(full), "slot", "left_semi")
    huge = within.groupBy("region").agg(F.count("*").alias("n")).filter(F.col("n") > PART)
    huge = stored(huge.select("region", F.ceil(2 * F.col("n") / F.lit(PART)).alias("pieces")), "huge")
    if huge.isEmpty():
        return cells
    names = cells.columns
    own = F.pmod(F.xxhash64("node", "region"), F.col("pieces"))
    cut = cells.join(huge, "region").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    cut = cut.withColumn("region", F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")))
    return cells.join(huge, "region", "left_anti").select(*names).unionByName(cut.select(*names))


def _regions(minima: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of minima of lines: line, and 32 bits that name the group (which minima they are, and their bytes)."""
    m = minima.astype(np.uint32)
    long = np.stack([m[:, i] << 16 | m[:, j] << 8 | m[:, k] | np.uint32(n << 24) for n, (i, j, k) in enumerate(TRIPLES)], axis=1)
    some = np.flatnonzero(words <= SHORT)
    m = m[some]
    short = np.stack([m[:, i] << 8 | m[:, j] | np.uint32(n << 24) for n, (i, j) in enumerate(PAIRS, len(TRIPLES))], axis=1)
    line = np.concatenate([np.repeat(np.arange(len(minima)), len(TRIPLES)), np.repeat(some, len(PAIRS))])
    return line, np.concatenate([long.ravel(), short.ravel()])


def _slot(region: np.ndarray) -> np.ndarray:
    return (region * np.uint32(0x9E3779B1) >> np.uint32(32 - (SLOTS - 1).bit_length())).astype(np.int64)


def _blocks(simhash: np.ndarray) -> np.ndarray:
    """The four 16-bit blocks of each SimHash, named by their place as well."""
    h = simhash.view(np.uint64)
    return np.stack([(h >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) | i << 16 for i in range(4)], axis=1)


def _large_cells(nodes: DataFrame, crowd: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of the SimHash that more than ``crowd`` lines share (sorted); groups of minima (sorted) that more than ``most``
    share, and in how many pieces to cut each of these."""
    # Groups are counted first by a part of their names; arrays of counts are summed task by task.
    parts, size = 32, (SLOTS + BLOCKS) // 32
    counted = StructType.fromDDL("part int, counts binary")
    counted_arrow = to_arrow_schema(counted)
    slots = StructType.fromDDL("slot long")
    slots_arrow = to_arrow_schema(slots)
    sizes = StructType.fromDDL("region long, n long")
    sizes_arrow = to_arrow_schema(sizes)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS + BLOCKS, np.int64)
        for batch in slices(batches, 20_000):
            total[:SLOTS] += np.bincount(_slot(_regions(_minima_of(batch.column(0)), batch.column(1).to_numpy())[1]), minlength=SLOTS)
            total[SLOTS:] += np.bincount(_blocks(batch.column(2).to_numpy()).ravel(), minlength=BLOCKS)
        for k in range(parts):
            if total[k * size:(k + 1) * size].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([total[k * size:(k + 1) * size].tobytes()], pa.binary())], schema=counted_arrow)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(c, np.int64)
        for k, c in total.items():
            slot = k * size + np.arange(size)
            yield pa.RecordBatch.from_arrays([pa.array(slot[c > np.where(slot < SLOTS, most, crowd)])], schema=slots_arrow)

    lines = nodes.select("minima", "words", "simhash")
    found = np.array(sorted(r["slot"] for r in lines.mapInArrow(counts, counted).repartition(8, "part").mapInArrow(
        full, slots).collect()), np.int64)
    crowded, found = found[found >= SLOTS] - SLOTS, found[found < SLOTS]
    if not len(found):
        return crowded, np.empty(0, np.uint32), np.empty(0, np.int64)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 20_000):
            region = _regions(_minima_of(batch.column(0)), batch.column(1).to_numpy())[1]
            names, n = np.unique(region[np.isin(_slot(region), found)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(n)], schema=sizes_arrow)

    huge = lines.mapInArrow(within, sizes).groupBy("region").agg(F.sum("n").alias("n")).filter(F.col("n") > most)
    rows = sorted((r["region"], r["n"]) for r in huge.collect())
    return crowded, np.array([r for r, _ in rows], np.uint32), np.array([-(-2 * n // most) for _, n in rows], np.int64)


def _minima_of(column: pa.Array) -> np.ndarray:
    column = unsliced(column)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[:len(column) * MINIMA].reshape(-1, MINIMA)


#: Cells packed for the way: (bucket, and the cells' columns one after the other), cells of the same name in the same bucket.
PACKED = "bucket int, cells binary"


def _packed(region: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    bucket = (mix64(region.astype(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in (region, *columns)]
    cuts = np.append(np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)), len(bucket))
    cells = [b"".join(c[i:j].tobytes() for c in columns) for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), pa.array(cells, pa.binary())],
                                      names=["bucket", "cells"])


def _groups_of_minima(nodes: DataFrame, buckets: int, huge: np.ndarray, pieces: np.ndarray) -> DataFrame:
    """Packed cells (region, chars, node, low, high) of lines that share a group of minima; huge groups as pieces, of
    which every two share a cell."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 20_000):
            minima = _minima_of(batch.column(3))
            line, region = _regions(minima, batch.column(2).to_numpy())
            node = batch.column(0).to_numpy()
            if len(huge):
                at = np.minimum(np.searchsorted(huge, region), len(huge) - 1)
                crowded = huge[at] == region
                a, r, number = line[crowded], region[crowded].astype(np.uint64), pieces[at[crowded]]
                own = (mix64(node[a].view(np.uint64) ^ mix64(r)) % number.astype(np.uint64)).astype(np.int64)
                a, r, own = (np.repeat(x, number) for x in (a, r, own))
                other = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                pair = (np.minimum(own, other) << 32 | np.maximum(own, other)).astype(np.uint64)
                line = np.concatenate([line[~crowded], a])
                region = np.concatenate([region[~crowded], (mix64(mix64(r) + pair) >> np.uint64(32)).astype(np.uint32)])
            chars = batch.column(1).to_numpy().astype(np.uint32)
            yield _packed(region, [chars[line], node[line], *(h[line] for h in _halves(minima))], buckets)

    return nodes.select("node", "chars", "words", "minima").mapInArrow(packed, PACKED)


def _calm_blocks(nodes: DataFrame, buckets: int, crowded: np.ndarray) -> DataFrame:
    """Packed cells (region, chars, node, simhash) of lines that share a block of the SimHash, but the crowded blocks."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        calm = np.ones(BLOCKS, bool)
        calm[crowded] = False
        for batch in slices(batches, 20_000):
            node, chars, simhash = (c.to_numpy() for c in batch.columns)
            region = _blocks(simhash).ravel()
            some = np.flatnonzero(calm[region])
            line = some // 4
            yield _packed(region[some].astype(np.uint32), [chars.astype(np.uint32)[line], node[line], simhash[line]], buckets)

    return nodes.select("node", "chars", "simhash").mapInArrow(packed, PACKED)


def _near_packed(batches: Iterator[pa.RecordBatch], sketches: int, least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The edges (see _near) of packed cells with so many words of sketches, sorted by bucket."""
    kinds = [np.uint32, np.uint32, np.int64, *[np.uint64] * sketches]
    width = sum(np.dtype(kind).itemsize for kind in kinds)
    for table, cuts in groups(batches, "bucket", 1):
        cells = flat_array(table["cells"])
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            parts: list[list[np.ndarray]] = [[] for _ in kinds]
            for k in range(start, stop):
                data = cells[k].as_buffer()
                n, at = len(data) // width, 0
                for p, kind in zip(parts, kinds, strict=True):
                    p.append(np.frombuffer(data, kind, n, at))
                    at += p[-1].nbytes
            region, chars, node, *h = (np.concatenate(p) for p in parts)
            key = region.astype(np.uint64) << np.uint64(32) | chars
            order = np.argsort(key)
            region = region[order]
            same = region[1:] == region[:-1]
            some = np.flatnonzero(np.append(same, False) | np.append(False, same))  # lines alone in their cell have no pair
            order, region = order[some], region[some]
            bounds = np.append(np.flatnonzero(np.diff(region.astype(np.int64), prepend=-1)), len(region))
            yield _near_edges(bounds, node[order], chars[order].astype(np.int64), [x[order] for x in h], least, schema)


def _agreement(low: np.ndarray, high: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many of their half bytes (low, high) lines ``a`` and ``b`` agree."""
    differ = np.zeros(len(a), np.int64)
    for half in (low, high):
        x = half[a] ^ half[b]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        differ += np.bitwise_count(x & np.uint64(0x1111111111111111))
    return MINIMA - differ


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the least row of each row's group), the groups of rows ``a`` and ``b`` being one from now on."""
    label = label.copy()
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up


def _pairs(cuts: np.ndarray, chars: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same group (rows between two cuts, sorted by chars) whose lengths allow the similarity."""
    sizes = np.diff(cuts)
    ends = np.repeat(cuts[1:], sizes)
    at = np.arange(len(chars))
    for lag in range(1, int(sizes.max(initial=1))):
        at = at[at + lag < ends[at]]
        at = at[lengths_allow(chars[at], chars[at + lag], least)]  # the lines further on are longer still
        if not len(at):
            return
        yield at, at + lag


def _near(batches: Iterator[pa.RecordBatch], columns: list[str], least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Spanning edges, and a name of what hangs together, of the lines of each region (sorted by chars) whose lengths allow
    the similarity and that differ in at most BLOCK_BITS bits (columns: simhash), or agree in AGREEING minima (columns: low, high)."""
    for table, cuts in groups(batches, "region", 20_000):
        h = [flat_array(table[c]).to_numpy(zero_copy_only=False).view(np.uint64) for c in columns]
        chars = flat_array(table["chars"]).to_numpy(zero_copy_only=False)
        yield _near_edges(cuts, flat_array(table["node"]).to_numpy(zero_copy_only=False), chars, h, least, schema)


def _near_edges(cuts: np.ndarray, nodes: np.ndarray, chars: np.ndarray, h: list[np.ndarray], least: float,
                schema: pa.Schema) -> pa.RecordBatch:
    label, a, b, held = np.arange(len(nodes)), [], [], 0
    for x, y in _pairs(cuts, chars, least):
        alike = (np.bitwise_count(h[0][x] ^ h[0][y]) <= BLOCK_BITS) if len(h) == 1 else _agreement(*h, x, y) >= AGREEING
        x, y = x[alike], y[alike]
        apart = label[x] != label[y]
        a.append(x[apart])
        b.append(y[apart])
        held += len(a[-1])
        if held > 1_000_000:
            label, a, b, held = _joined(label, np.concatenate(a), np.concatenate(b)), [], [], 0
    if a:
        label = _joined(label, np.concatenate(a), np.concatenate(b))
    # The lines that hang together are named by all of them, their edges go out from the least node.
    some = np.flatnonzero(np.bincount(label, minlength=len(label))[label] > 1)
    some = some[np.lexsort((nodes[some], label[some]))]
    first = np.flatnonzero(np.diff(label[some], prepend=-1))
    count = np.diff(np.append(first, len(some)))
    own = nodes[some].astype(np.int64)
    total = np.add.reduceat(mix64(own.view(np.uint64)), first) if len(first) else np.empty(0, np.uint64)
    rest = np.ones(len(some), bool)
    rest[first] = False
    names = np.repeat(total, count)[rest].astype(">u8")
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(own[first], count)[rest]), pa.array(own[rest]), _binary(names.tobytes(), 8)], schema=schema)


def _binary(data: bytes, width: int) -> pa.Array:
    """Binary values of ``width`` bytes each."""
    number = len(data) // width
    offsets = np.arange(0, len(data) + 1, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), number, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _texts(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The normalised texts of wanted lines (rows: text, array of struct unit, node, simhash, minima, line)."""
    for batch in slices(batches, 1000):
        parts = pc.split_pattern(unsliced(batch.column(0)).cast(pa.large_string()), "\n")
        lists = batch.column(1)
        number = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        wanted = lists.flatten()
        starts = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        at = np.repeat(starts, number) + wanted.field("line").to_numpy()
        lines = parts.flatten().take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [*(wanted.field(c) for c in ("unit", "node", "simhash", "minima")), normalised(lines).cast(pa.string())], schema=schema)


def _confirmed(batches: Iterator[pa.RecordBatch], least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Spanning links of each unit: candidates of each other and similar enough (rows: unit, node, simhash, minima, text)."""
    for table, cuts in groups(batches, "unit", 20_000):
        nodes = flat_array(table["node"]).to_numpy(zero_copy_only=False)
        unit = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        size = pc.utf8_length(flat_array(table["text"])).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.concatenate([[True], (nodes[1:] != nodes[:-1]) | (unit[1:] != unit[:-1])])
        rows = np.flatnonzero(new)
        rows = rows[np.lexsort((size[rows], unit[rows]))]
        nodes, unit, size = nodes[rows], unit[rows], size[rows]
        cuts = np.concatenate([np.flatnonzero(np.diff(unit, prepend=-1)), [len(rows)]])
        h = flat_array(table["simhash"]).to_numpy(zero_copy_only=False).view(np.uint64)[rows]
        low, high = _halves(np.frombuffer(b"".join(table["minima"].to_pylist()), np.uint8).reshape(-1, MINIMA)[rows])
        texts = flat_array(table["text"]).take(pa.array(rows)).to_pylist()
        counts = bigram_counts(texts)

        def decided(label: np.ndarray, a: np.ndarray, b: np.ndarray, size=size, texts=texts, counts=counts) -> np.ndarray:
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
            yes = np.zeros(len(a), bool)
            for start in range(0, len(a), 500):
                x, y = a[start:start + 500], b[start:start + 500]
                yes[start:start + 500] = may_be_similar(np.minimum(counts[x], counts[y]).sum(axis=1), np.maximum(size[x], size[y]), least)
            a, b = a[yes], b[yes]
            limits = np.floor((1 - least) * np.maximum(size[a], size[b]) + 1e-9).astype(np.int64)
            yes = few_edits([texts[k] for k in a.tolist()], [texts[k] for k in b.tolist()], limits)
            return _joined(label, a[yes], b[yes])

        label, a, b, held, most = np.arange(len(rows)), [], [], 0, PENDING[0]
        for x, y in _pairs(cuts, size, least):
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            alike = (np.bitwise_count(h[x] ^ h[y]) <= BLOCK_BITS) | (_agreement(low, high, x, y) >= AGREEING)
            a.append(x[alike])
            b.append(y[alike])
            held += len(a[-1])
            if held > most:
                label, a, b, held = decided(label, np.concatenate(a), np.concatenate(b)), [], [], 0
                most = min(2 * most, PENDING[1])
        if held:
            label = decided(label, np.concatenate(a), np.concatenate(b))
        linked = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[label[linked]]), pa.array(nodes[linked])], schema=schema)


def _halves(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The upper four bits of the minima, 16 in a 64-bit word."""
    upper = minima & 0xF0
    both = np.ascontiguousarray(upper[:, ::2] | upper[:, 1::2] >> 4).view(np.uint64)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def _mixed(place: Column) -> Column:
    """A bijection that scatters neighbouring rows, as names in order would make long chains of least neighbours."""
    low = F.lit((1 << 22) - 1)
    return F.shiftleft(F.shiftrightunsigned(place, 22), 22).bitwiseOR((place.bitwiseAND(low) * F.lit(2654435)).bitwiseAND(low))


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_r, hash_r, dropped, kept_in): the numbers, from 0, of the lines to drop from the documents that have
    any, and the ids of the documents in which each one's group keeps its line."""
    spark = ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, text_hash long, line int, node binary, simhash long, minima binary, words int, chars int")
    arrow = to_arrow_schema(schema)
    lines = stored(rows.mapInArrow(lambda it: _occurrences(it, min_words, arrow), schema), "lines")
    nodes = stored(lines.groupBy("node").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "text_hash", "line")).alias("first"),
        F.min("simhash").alias("simhash"), F.min("minima").alias("minima"), F.min("words").alias("words"),
        F.min("chars").alias("chars")), "line-nodes")

    # In the search a node goes by its place in the stored table, mixed: a few bytes instead of sixteen.
    part = F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).cast("long")
    place = F.shiftleft(part, 28).bitwiseOR(F.col("_metadata.row_index"))
    nodes = nodes.select(*[F.col(c) for c in nodes.columns if c != "node"], F.col("node").alias("key"),
                         _mixed(place).alias("node"))
    pair = StructType.fromDDL("a long, b long")
    pair_arrow = to_arrow_schema(pair)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edge = StructType.fromDDL("a long, b long, region binary")
    edge_arrow = to_arrow_schema(edge)

    def unpacked(cells: DataFrame, sketches: int) -> DataFrame:
        cells = cells.repartition(width, "bucket").sortWithinPartitions("bucket")
        return stored(cells.mapInArrow(lambda it: _near_packed(it, sketches, similarity, edge_arrow), edge), "line-near")

    crowded, huge, pieces = _large_cells(nodes, CROWD, PART)
    near = unpacked(_calm_blocks(nodes, 4 * width, crowded), 1).unionByName(
        unpacked(_groups_of_minima(nodes, 4 * width, huge, pieces), 2))
    if len(crowded):
        cells = _cells(nodes.select("node", "simhash", "chars"), crowded)
        cells = cells.repartition(width, "region").sortWithinPartitions("region", "chars").select("region", "node", "chars", "simhash")
        near = near.unionByName(stored(cells.mapInArrow(lambda it: _near(it, ["simhash"], similarity, edge_arrow), edge), "line-near"))
    candidates = stored(connected_components(near.select("a", "b")), "line-candidates")
    weighed = candidates.select("node", F.unhex(F.hex("root")).alias("root"), F.lit(1).alias("weight"))
    cells = near.select("region", F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = units(weighed, cells, COMPONENT).join(nodes.select("node", "first", "simhash", "minima"), "node")
    wanted = stored(wanted.groupBy(F.col("first.doc_id").alias("id_r"), F.col("first.text_hash").alias("hash_r")).agg(
        F.collect_list(F.struct("unit", "node", "simhash", "minima", F.col("first.line").alias("line"))).alias("wanted")), "wanted")
    text_schema = StructType.fromDDL("unit binary, node long, simhash long, minima binary, text string")
    text_arrow = to_arrow_schema(text_schema)
    texts = rows.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id_r")) & (F.col("text_hash") == F.col("hash_r")))
    texts = texts.select("text", "wanted").mapInArrow(
        lambda it: _texts(it, text_arrow), text_schema)
    texts = texts.repartition(width, "unit").sortWithinPartitions("unit", "node")
    links = stored(texts.mapInArrow(lambda it: _confirmed(it, similarity, pair_arrow), pair), "line-links")
    roots = connected_components(links)

    # Lines that occur more than once or have a link: their group's first occurrence stays.
    groups_ = nodes.select("key", "node", "n", "first").join(roots, "node", "left").filter((F.col("n") > 1) | F.col("root").isNotNull())
    groups_ = stored(groups_.select(F.col("key").alias("node"), F.coalesce("root", "node").alias("root"), "first"), "line-groups")
    firsts = groups_.groupBy("root").agg(F.min("first").alias("winner"))
    winners = stored(groups_.join(firsts, "root").select("node", "winner"), "line-winners")
    again = lines.join(winners, "node").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("winner.doc_id")) & (F.col("text_hash") == F.col("winner.text_hash"))
          & (F.col("line") == F.col("winner.line"))))
    drops = again.groupBy(F.col("doc_id").alias("id_r"), F.col("text_hash").alias("hash_r")).agg(
        F.array_sort(F.collect_set(F.struct("line", F.col("winner.doc_id").alias("kept")))).alias("d"))
    return stored(drops.select("id_r", "hash_r", F.col("d.line").alias("dropped"), F.col("d.kept").alias("kept_in")), "line-drops")


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_lines``, ``dropped`` (line numbers from 0), ``kept_in`` (for each, the id of the document
    that keeps its group's line) and the remaining ``text`` of every row."""
    drops = repeated_lines(docs, similarity, min_words, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, n_lines int, dropped array<int>, kept_in array<{kind}>, text string")
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            number, texts = [], []
            dropped = batch.column(2).to_pylist()
            for text, gone in zip(batch.column(1).to_pylist(), dropped, strict=True):
                lines = [] if text is None else text.split("\n")
                number.append(len(lines))
                texts.append(without(text, gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number, pa.int32()), batch.column(2).cast(arrow.field(2).type),
                 batch.column(3).cast(arrow.field(3).type), pa.array(texts, pa.string())], schema=arrow)

    found = rows.join(drops.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id_r")) & (F.col("text_hash") == F.col("hash_r")), "left")
    return found.select("doc_id", "text", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
                        F.coalesce("kept_in", F.array().cast(f"array<{kind}>")).alias("kept_in")).mapInArrow(cut, schema)


def drop_repeated_lines(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, without their repeated lines.

    Rows of which no word is left go; an ``n_chars`` column follows the text.
    """
    drops = repeated_lines(docs, similarity, min_words, id_col, text_col).select(
        F.col("id_r").alias("__id"), F.col("hash_r").alias("__hash_r"), F.col("dropped").alias("__dropped"))
    rows = docs.withColumn("__hash", F.xxhash64(F.col(text_col).cast("string")))
    joined = rows.join(drops.hint("merge"), F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__hash_r")), "left")
    at, number = docs.columns.index(text_col), len(docs.columns)
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [batch.column(i) for i in range(number)]
            gone = batch.column(number).to_pylist()
            some = [i for i, g in enumerate(gone) if g]
            if some:
                texts, keep = columns[at].to_pylist(), np.ones(batch.num_rows, bool)
                for i in some:
                    texts[i] = without(texts[i], gone[i])
                    keep[i] = bool(texts[i].split())
                columns[at] = pa.array(texts, columns[at].type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    sizes = [len(texts[i]) if gone[i] else n for i, n in enumerate(columns[k].to_pylist())]
                    columns[k] = pa.array(sizes, columns[k].type)
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))
            else:
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.select(*docs.columns, "__dropped").mapInArrow(cut, docs.schema)


def without(text: str | None, dropped: list[int] | None) -> str | None:
    if text is None or not dropped:
        return text
    gone = set(dropped)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
