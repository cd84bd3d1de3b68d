"""PII: fixed patterns, and a semi-Markov conditional random field that adds to them.

The patterns (email, ip, card, phone) give the base spans, exactly as their
rules say.  The field labels white-space separated words around digits, at
signs and spelled-out ones.  A segment of up to five words is scored as a whole (its shape, digit
count, checksum, octets, number of words, neighbours) for each type, words
outside any entity one by one, and neighbouring segments by their types; a
dynamic program over segments of bounded length chooses boundaries and types
jointly.  It is trained by the gradient of the segment-level conditional
likelihood, on a bounded sample of the windows around digits and at signs of
all texts, wherever in a text they stand, as they are and rewritten in ways
that the patterns miss (other separators, missing country code, spelled-out at
and dot) or into numbers that are nothing personal.  Predicted entities that
touch no base span are added.

Scale.  Two scans in Arrow batches.  The first keeps the windows of least hash,
in each task and then of all tasks, windows with base spans and without each up
to the bound; the second searches.  Texts without a digit or an at sign need no
further look; the weights (2**14 x 5) are the only broadcast.

Defined cases: null and empty texts have no spans; equal rows are searched
each for itself; a corpus without base spans adds nothing; overlapping base
spans of different kinds all stay; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import ship_package, slices, stored, unsliced

KINDS = ("email", "ip", "card", "phone")
#: Patterns of the contract (fixed values).
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LONGEST = 5
CONTEXT = 3
BUCKETS = 1 << 14
#: Characters of the widest window that serves as an example.
WIDEST = 2000
#: What a word that may begin or end an entity contains.
TRIGGER = re.compile(r"[0-9@]|\(at\)|\[at\]|\[\.\]")
#: A name, host and ending with spelled-out signs between them: the words before and after are triggers.
SPELLED = re.compile(r"(?<![^\x20\x09-\x0D])[A-Za-z0-9._%+-]+ at [A-Za-z0-9-]+(?: dot [A-Za-z0-9-]+)+", re.IGNORECASE)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = "!\"#$%&'*,./:;<=>?\\^_`{|}~-"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns' valid matches, by start and kind."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if octets(m.group().split(".")):
            found.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


# --- windows and their segments ------------------------------------------------

@dataclass
class Segments:
    """Candidate segments of one window: words [i, i + d), character span, feature rows."""

    size: int
    start: np.ndarray
    length: np.ndarray
    spans: list[tuple[int, int]]
    features: list[list[int]]


def spelled_out(text: str) -> set[int]:
    """Where addresses with spelled-out signs begin, and where words at their end do."""
    found = set()
    if " dot " in text.lower():
        for m in SPELLED.finditer(text):
            last = WORD.match(text, m.end() - len(m.group().rsplit(" ", 1)[1]))
            found |= {m.start(), last.end()}
    return found


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words around words with a trigger, CONTEXT words to either side."""
    spelled = spelled_out(text)
    if not spelled and not TRIGGER.search(text):
        return
    words, marked = [], []
    for m in WORD.finditer(text):
        if m.start() in spelled or m.end() in spelled or TRIGGER.search(m.group()):
            marked.append(len(words))
        words.append(m.span())
    k = 0
    while k < len(marked):
        low = high = marked[k]
        while k < len(marked) and marked[k] - high <= 2 * CONTEXT:
            high = marked[k]
            k += 1
        yield words[max(0, low - CONTEXT):high + CONTEXT + 1]


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def _inner(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without punctuation at its edges (brackets and a plus may open it, brackets close it)."""
    while start < end and text[start] in EDGES:
        start += 1
    while end > start and text[end - 1] in EDGES:
        end -= 1
    return start, end


def span_features(text: str, start: int, end: int, words: int, left: str, right: str) -> list[int]:
    value = text[start:end]
    digits = "".join(c for c in value if "0" <= c <= "9")
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", value))
    exact = re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", value))
    spelled = SPELLED.fullmatch(value) is not None
    at = spelled or "@" in value or "(at)" in value or "[at]" in value
    # Digits say nothing about an address.
    number = "address" if at else f"{min(len(digits), 24)}"
    names = ["bias", f"words:{words}", f"shape:{shape[:40]}", f"exact:{exact[:40]}", f"digits:{number}",
             f"letters:{any(c.isalpha() for c in value)}", f"luhn:{12 <= len(digits) <= 19 and luhn(digits)}",
             f"octets:{octets(re.findall('[0-9]+', value)) and not any(c.isalpha() for c in value)}",
             f"at:{at}:{'.' in value or 'dot' in value}", f"spelled:{spelled}",
             f"first:{exact[:1]}", f"last:{exact[-1:]}", f"plus:{value[:1] == '+'}", f"space:{' ' in value}:{at or len(digits) > 0}",
             f"left:{left[-12:].lower()}", f"right:{right[:12].lower()}"]
    return [_hash(n) for n in names]


def candidates(text: str, words: list[tuple[int, int]]) -> Segments:
    """Single words, and longer segments that begin and end at a word with a trigger, on one line."""
    low = words[0][0] if words else 0
    spelled = {low + at for at in spelled_out(text[low:words[-1][1]])} if words else set()
    trigger = [a in spelled or b in spelled or bool(TRIGGER.search(text[a:b])) for a, b in words]
    start, length, spans, features = [], [], [], []
    for i in range(len(words)):
        for d in range(1, min(LONGEST, len(words) - i) + 1):
            if d > 1:
                if not (trigger[i] and trigger[i + d - 1]):
                    continue
                if "\n" in text[words[i][0]:words[i + d - 1][1]]:
                    break
            a, b = _inner(text, words[i][0], words[i + d - 1][1])
            left = text[slice(*words[i - 1])] if i else ""
            right = text[slice(*words[i + d])] if i + d < len(words) else ""
            start.append(i)
            length.append(d)
            spans.append((a, b))
            features.append(span_features(text, a, b, d, left, right))
    return Segments(len(words), np.array(start), np.array(length), spans, features)


# --- the field ------------------------------------------------------------------

LABELS = len(KINDS) + 1  # 0: outside


def scores(segments: Segments, weights: np.ndarray) -> np.ndarray:
    s = weights[np.array(segments.features)].sum(axis=1)
    s[segments.length > 1, 0] = -np.inf  # outside goes word by word
    return s


def _by_end(segments: Segments) -> list[list[int]]:
    ends: list[list[int]] = [[] for _ in range(segments.size + 1)]
    for k, (i, d) in enumerate(zip(segments.start.tolist(), segments.length.tolist(), strict=True)):
        ends[i + d].append(k)
    return ends


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - np.where(np.isfinite(top), top, 0)).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(segments: Segments, s: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(segment, label), expected transitions and the log partition, by forward-backward over segments.

    ``move`` has a row more than labels: from the window's begin.
    """
    n, ends = segments.size, _by_end(segments)
    begins: list[list[int]] = [[] for _ in range(n + 1)]
    for k, i in enumerate(segments.start.tolist()):
        begins[i].append(k)
    alpha = np.full((n + 1, LABELS), -np.inf)
    enter = np.full((n + 1, LABELS), -np.inf)  # log mass of starting a segment of a label at a position
    enter[0] = move[LABELS]
    for j in range(1, n + 1):
        for k in ends[j]:
            alpha[j] = np.logaddexp(alpha[j], enter[segments.start[k]] + s[k])
        with np.errstate(invalid="ignore"):
            enter[j] = _logsum(alpha[j][:, None] + move[:LABELS], 0)
    total = float(_logsum(alpha[n], 0))
    beta = np.full((n + 1, LABELS), -np.inf)  # after a segment of a label that ends here
    beta[n] = 0
    inside = np.full((n + 1, LABELS), -np.inf)  # best of segments that start here
    gamma = np.zeros_like(s)
    expected = np.zeros_like(move)
    for i in range(n - 1, -1, -1):
        for k in begins[i]:
            mass = s[k] + beta[i + segments.length[k]]
            inside[i] = np.logaddexp(inside[i], mass)
            gamma[k] = np.exp(enter[i] + mass - total)
        if i:
            joint = alpha[i][:, None] + move[:LABELS] + inside[i][None, :] - total
            expected[:LABELS] += np.exp(joint)
            beta[i] = _logsum(move[:LABELS] + inside[i][None, :], 1)
        else:
            expected[LABELS] += np.exp(move[LABELS] + inside[0] - total)
    return gamma, expected, total


def decode(segments: Segments, s: np.ndarray, move: np.ndarray) -> list[tuple[int, int]]:
    """The best segmentation's entities: (segment, label)."""
    n, ends = segments.size, _by_end(segments)
    best = np.full((n + 1, LABELS), -np.inf)
    back = np.zeros((n + 1, LABELS), np.int64)
    enter = np.full((n + 1, LABELS), -np.inf)
    came = np.zeros((n + 1, LABELS), np.int64)
    enter[0] = move[LABELS]
    for j in range(1, n + 1):
        for k in ends[j]:
            value = enter[segments.start[k]] + s[k]
            better = value > best[j]
            best[j][better], back[j][better] = value[better], k
        step = best[j][:, None] + move[:LABELS]
        enter[j], came[j] = step.max(axis=0), step.argmax(axis=0)
    out, j, label = [], n, int(best[n].argmax())
    while j:
        k = int(back[j][label])
        if label:
            out.append((k, label))
        j = int(segments.start[k])
        label = int(came[j][label])
    return out[::-1]


# --- training -------------------------------------------------------------------

def _rewritten(rng: np.random.Generator, value: str, kind: int) -> tuple[str, int]:
    """A form of the value that the patterns miss, or something that is nothing personal (kind -1)."""
    digits = re.sub("[^0-9]", "", value)
    pick = int(rng.integers(0, 4))
    if kind == 0:
        name, _, host = value.partition("@")
        if rng.random() < 0.5:
            ending = host.rsplit(".", 1)
            return f"{name} at {ending[0].rsplit('.', 1)[-1]} dot {ending[-1]}", 0
        return [(f"{name}(at){host}", 0), (f"{name}[at]{host}", 0), (f"{name}@{host.split('.')[0]}", -1),
                (f"{name}.{host.split('.')[0]}", -1)][pick]
    if kind == 1:
        parts = value.split(".")
        return [("[.]".join(parts), 1), (".".join(parts[:3]), -1), (".".join(parts[:2]), -1),
                (".".join(str(int(p) + 300) for p in parts), -1)][pick]
    if kind == 2:
        groups = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + int(rng.integers(0, 8))) % 10)
        return [(".".join(groups), 2), ("/".join(groups), 2), (wrong, -1), (digits[:int(rng.integers(5, 11))], -1)][pick]
    local = digits[-10:]
    return [(f"({local[:3]}) {local[3:6]}-{local[6:]}", 3), (f"{local[:3]}-{local[3:6]}-{local[6:]}", 3),
            (f"{local[:3]}.{local[3:6]}.{local[6:]}", 3), (f"{local[:4]}-{local[4:6]}-{local[6:8]}", -1)][pick]


def _doubtful(part: str, gold: list[tuple[int, int, int]]) -> bool:
    """Whether something outside the base spans may be personal: long numbers, spelled-out at signs.

    The patterns say nothing about these, so they are no examples of words outside.
    """
    free = list(part)
    for a, b, _ in gold:
        free[a:b] = "\n" * (b - a)
    rest = "".join(free)
    return bool(re.search(r"\(at\)|\[at\]|\[\.\]", rest) or SPELLED.search(rest)) or any(
        sum("0" <= c <= "9" for c in m.group()) >= 7
        for m in re.finditer(r"(?<![^\W_])[+(]?[0-9][\x20().0-9/-]*[0-9](?![^\W_])", rest))


def gold_windows(text: str) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Every window of the text with the base spans inside it, but for those about which the patterns say nothing."""
    spans, first = base_spans(text), 0
    for words in windows(text):
        low, high = words[0][0], words[-1][1]
        gold: list[tuple[int, int, int]] = []
        while first < len(spans) and spans[first][0] < high:
            a, b, k = spans[first]
            if a >= low and b <= high and (not gold or a - low >= gold[-1][1]):
                gold.append((a - low, b - low, k))
            first += 1
        if high - low <= WIDEST and not _doubtful(text[low:high], gold):
            yield text[low:high], gold


def examples(found: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 5) -> list[tuple[Segments, list[tuple[int, int]]]]:
    """Windows with their gold segments (index, label) for all words, those with base spans also rewritten."""
    rng = np.random.default_rng(seed)
    out = []
    for part, gold, rewrite in [(*w, False) for w in found] + [(*w, True) for w in found if w[1]]:
        cut = 0
        if rewrite:
            changed = []
            for a, b, k in gold:
                new, kind = _rewritten(rng, part[a + cut:b + cut], k)
                part = part[:a + cut] + new + part[b + cut:]
                if kind >= 0:
                    changed.append((a + cut, a + cut + len(new), kind))
                cut += len(new) - (b - a)
            gold = changed
        segments = candidates(part, [m.span() for m in WORD.finditer(part)])
        if not segments.size:
            continue
        at = {s: k for k, s in enumerate(zip(segments.spans, segments.length.tolist(), strict=True))}
        entity = {}
        for a, b, k in gold:
            for d in range(1, LONGEST + 1):
                if (index := at.get(((a, b), d))) is not None:
                    entity[int(segments.start[index])] = (index, k + 1)
        single = {int(i): k for k, (i, d) in enumerate(zip(segments.start, segments.length, strict=True)) if d == 1}
        path, i = [], 0
        while i < segments.size:
            k, label = entity.get(i, (single[i], 0))
            path.append((k, label))
            i += int(segments.length[k])
        if i == segments.size:
            out.append((segments, path))
    return out


def fit(found: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 4, seed: int = 5) -> tuple[np.ndarray, np.ndarray] | None:
    """Segment weights and transitions (with a last row from the begin); None without any entity to learn from."""
    data = examples(found, seed)
    if not any(label for _, path in data for _, label in path):
        return None
    rng = np.random.default_rng(seed)
    weights, move = np.zeros((BUCKETS, LABELS)), np.zeros((LABELS + 1, LABELS))
    squares, move_squares = np.full_like(weights, 1e-3), np.full_like(move, 1e-1)
    for _ in range(epochs):
        for at in rng.permutation(len(data)):
            segments, path = data[at]
            gamma, expected, _ = marginals(segments, scores(segments, weights), move)
            before = LABELS
            for k, label in path:
                gamma[k, label] -= 1
                expected[before, label] -= 1
                before = label
            rows = np.array(segments.features)
            flat, g = rows.ravel(), np.repeat(gamma, rows.shape[1], axis=0)
            seen, place = np.unique(flat, return_inverse=True)
            total = np.zeros((len(seen), LABELS))
            np.add.at(total, place, g)
            squares[seen] += total * total
            weights[seen] -= 0.2 * total / np.sqrt(squares[seen])
            move_squares += expected * expected
            move -= 0.2 * expected / np.sqrt(move_squares)
    return weights, move


def added_spans(text: str, base: list[tuple[int, int, int]], model: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int, int]]:
    """The field's entities that touch no base span."""
    out = []
    for words in windows(text):
        segments = candidates(text, words)
        for k, label in decode(segments, scores(segments, model[0]), model[1]):
            a, b = segments.spans[k]
            if a < b and not any(a < e and s < b for s, e, _ in base):
                out.append((a, b, label - 1))
    return out


# --- the operator ----------------------------------------------------------------

def window_sample(rows: DataFrame, most: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most ``most`` windows with base spans and ``most`` without, those of least hash over all whole texts.

    The hash is of the window alone, so equal windows count once.
    """
    schema = "filled boolean, key long, part string, gold array<struct<start:int,end:int,kind:int>>"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, dict[int, tuple]] = {False: {}, True: {}}
        bound = {False: 1 << 63, True: 1 << 63}
        for batch in slices(batches):
            for text in batch.column(0):
                for part, gold in gold_windows(text.as_py()):
                    filled = bool(gold)
                    key = xxhash.xxh64_intdigest(part.encode()) >> 1
                    if key < bound[filled]:
                        own = kept[filled]
                        own[key] = (part, gold)
                        if len(own) > 2 * most:
                            keys = sorted(own)[:most]
                            kept[filled], bound[filled] = {x: own[x] for x in keys}, keys[-1]
        for filled, own in kept.items():
            keys = sorted(own)[:most]
            if keys:
                yield pa.RecordBatch.from_arrays([
                    pa.array([filled] * len(keys)), pa.array(keys, pa.int64()), pa.array([own[x][0] for x in keys], arrow.field(2).type),
                    pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in own[x][1]] for x in keys], arrow.field(3).type)],
                    schema=arrow)

    likely = rows.filter(F.col("text").rlike("[0-9@]")).select("text")
    found = stored(likely.mapInArrow(least, schema), "pii-windows")
    out = []
    for filled in (True, False):
        chosen = found.filter(F.col("filled") == filled).dropDuplicates(["key"]).orderBy("key").limit(most).collect()
        out += [(r["key"], r["part"], [(g["start"], g["end"], g["kind"]) for g in r["gold"]]) for r in chosen]
    return [(part, gold) for _, part, gold in sorted(out)]


def find_pii(docs: DataFrame, sample: int = 1500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, added; code points, end exclusive) of every row.

    ``sample`` bounds the windows with base spans, and those without, that the
    field is trained on; windows of over 2,000 characters are no examples.
    """
    spark = ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = fit(window_sample(rows, sample))
    if model is not None:
        model = tuple(m.astype(np.float32) for m in model)
    shared = spark.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int,added:boolean>>")
    arrow = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in slices(batches):
            texts = unsliced(batch.column(1))
            likely = pc.fill_null(pc.match_substring_regex(texts, r"[0-9@]|\(at\)|\[at\]|\[\.\]|(?i: at .* dot )"), False).to_numpy(zero_copy_only=False)
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(likely).tolist():
                text = texts[i].as_py()
                base = base_spans(text)
                more = added_spans(text, base, field) if field is not None else []
                spans = sorted([(*s, False) for s in base] + [(*s, True) for s in more], key=lambda s: (s[0], s[2]))
                out[i] = [{"kind": KINDS[k], "start": a, "end": b, "added": new} for a, b, k, new in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow.field(1).type)], schema=arrow)

    return rows.mapInArrow(search, schema)
