"""License scans: winnowed fingerprints in an inverted index, then banded sequence alignment.

Words are runs of letters, digits and non-ASCII bytes, A-Z lowered. Of every WINDOW successive GRAM-word hashes the least is
kept (the last of equals), in templates and texts alike, so any run of GRAM + WINDOW - 1 words that a text shares with a
template yields a common fingerprint. Shorter templates are not winnowed: all their runs of two words (of one, where one
word is a match) are looked up at every place of a text, and an alignment of several words always begins with two in a
row. Fingerprints of one template on neighbouring diagonals make a
candidate; a local alignment inside a band around them (match 1, mismatch and gap -1) gives the matched words, their share
of the template and their span in the text.

A text may hold several matches, also of templates that contain each other; each is a row. Matches need MIN_MATCHED equal
words, or all words of a template that has fewer, and MIN_COVERAGE of the template. A template without words matches nothing.

Defined results: NULL, empty and clean texts give no rows; of equal matches of one text and template one is given;
repeated rows give their matches each; a NULL id stays NULL; other columns are not read; an empty frame gives an empty frame. Texts
are scanned whole; templates are a parameter and must fit every task.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.llm.columns import map_arrow, mix64, row_blocks, text_bytes
from wardlog.llm.gru import Words
from wardlog.llm.license_texts import TEMPLATES
from wardlog.llm.words import table

GRAM, WINDOW = 3, 3
SHORT = GRAM + WINDOW - 1  # templates of fewer words are not winnowed
MIN_MATCHED, MIN_COVERAGE = 5, 0.5
BLOCK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(hashes: np.ndarray, size=GRAM) -> np.ndarray:
    n = max(0, len(hashes) - size + 1)
    out = mix64(hashes[:n])
    for k in range(1, size):
        out = mix64(out + hashes[k:k + n])
    return out


def winnow(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Positions kept; row says which text each hash is of. A text of fewer than WINDOW hashes is one window."""
    n = len(values)
    keep = np.zeros(n, bool)
    if not n:
        return np.flatnonzero(keep)
    first = np.searchsorted(row, row, side="left")
    end = np.searchsorted(row, row, side="right")
    start = np.arange(n)
    whole = (start + WINDOW <= end) | (start == first)  # windows that begin here
    start = start[whole]
    stop = np.minimum(start + WINDOW, end[start])
    best = start.copy()
    for k in range(1, WINDOW):
        at = start + k
        inside = at < stop
        better = np.flatnonzero(inside)
        better = better[values[at[better]] <= values[best[better]]]
        best[better] = at[better]
    keep[best] = True
    return np.flatnonzero(keep)


def _least_words(length: int, min_matched: int, min_coverage: float) -> int:
    """Equal words that a match of a template needs."""
    return max(1, min(min_matched, length), math.ceil(min_coverage * length))


class Postings:
    """Hashes with the template and the place in it, ordered by hash."""

    def __init__(self, found: list[tuple[np.ndarray, int, np.ndarray]]):
        value = np.concatenate([np.empty(0, np.uint64), *(v for v, _, _ in found)])
        owner = np.concatenate([np.empty(0, np.int64), *(np.full(len(v), n) for v, n, _ in found)])
        place = np.concatenate([np.empty(0, np.int64), *(p for _, _, p in found)])
        order = np.argsort(value, kind="stable")
        self.value, self.owner, self.place = value[order], owner[order], place[order]

    def found(self, values: np.ndarray) -> np.ndarray:
        """Which of the values are here."""
        if not len(self.value):
            return np.empty(0, np.int64)
        low = np.searchsorted(self.value, values)
        return np.flatnonzero(self.value[np.minimum(low, len(self.value) - 1)] == values)

    def of(self, values: np.ndarray):
        """For every value found: its number among the values, template, and place in the template."""
        out = []
        for i in self.found(values).tolist():
            at = int(np.searchsorted(self.value, values[i]))
            while at < len(self.value) and self.value[at] == values[i]:
                out.append((i, int(self.owner[at]), int(self.place[at])))
                at += 1
        return out


class Index:
    """Templates as word hashes, an inverted index of their fingerprints, and one of the short templates' runs by their size."""

    def __init__(self, templates: dict[str, str], min_matched=MIN_MATCHED, min_coverage=MIN_COVERAGE):
        self.names = list(templates)
        self.words, long, short = [], [], {1: [], 2: []}
        for n, text in enumerate(templates.values()):
            data = _LOWER[np.frombuffer(text.encode(), np.uint8)]
            hashes = Words(data, np.array([0, len(data)]), with_runs=False).hash
            self.words.append(hashes)
            if len(hashes) < SHORT:
                size = min(2, _least_words(len(hashes), min_matched, min_coverage))
                g = grams(hashes, size)
                short[size].append((g, n, np.arange(len(g))))
                continue
            g = grams(hashes)
            kept = winnow(g, np.zeros(len(g), np.int64))
            long.append((g[kept], n, kept))
        self.long = Postings(long)
        self.short = {size: Postings(found) for size, found in short.items() if found}

    def postings(self, values: np.ndarray):
        """Fingerprints found: number among the values, template, and place in the template."""
        return self.long.of(values)

    def short_hits(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """Runs of short templates in one text: place in the text, template, place."""
        return [hit for size, runs in self.short.items() for hit in runs.of(grams(hashes, size))]

    def rows_with_short(self, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Texts of a block that hold a run of a short template; row says which text each word is of."""
        out = [np.empty(0, row.dtype)]
        for size, runs in self.short.items():
            at = runs.found(grams(hashes, size))
            out.append(row[at[row[at] == row[at + size - 1]]])
        return np.unique(np.concatenate(out))


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Best local alignment with low <= text place - template place <= high: pairs of equal words, in order.

    A row per template word over the diagonals of the band; gaps along a row are a running maximum.
    """
    width, rows = high - low + 1, len(template)
    steps = np.arange(width)
    score = np.zeros((rows + 1, width + 1), np.int32)  # the last column is a border
    for i in range(rows):
        at = i + low + steps
        inside = (at >= 0) & (at < len(text))
        equal = inside & (text[np.clip(at, 0, len(text) - 1)] == template[i])
        across = score[i, :width] + np.where(equal, 1, -1)
        down = score[i, 1:] - 1  # a template word without partner: one diagonal back
        best = np.maximum(np.maximum(across, down), 0)
        best = np.where(inside, best, 0)
        best = np.maximum.accumulate(best + steps) - steps  # text words without partner
        score[i + 1, :width] = np.where(inside, best, 0)
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    pairs = []
    while i > 0 and score[i, j] > 0:
        place = i - 1 + low + j
        here, equal = score[i, j], text[place] == template[i - 1]
        if here == score[i - 1, j] + (1 if equal else -1):
            if equal:
                pairs.append((int(i - 1), int(place)))
            i -= 1
        elif j + 1 < width and here == score[i - 1, j + 1] - 1:
            i, j = i - 1, j + 1
        elif j and here == score[i, j - 1] - 1:
            j -= 1
        else:
            break
    return pairs[::-1]


def matches(index: Index, hashes: np.ndarray, hits, min_matched=MIN_MATCHED, min_coverage=MIN_COVERAGE):
    """(template, matched, first word, last word) of one text; hits are (place in the text, template, place) of its
    fingerprints. Short templates are looked up here."""
    out, known = set(), {}
    by_template: dict[int, list[tuple[int, int]]] = {}
    for place, owner, at in [*hits, *index.short_hits(hashes)]:
        by_template.setdefault(owner, []).append((place - at, place))
    for owner, found in by_template.items():
        template = index.words[owner]
        band = min(max(2, len(template) // 8), len(template) - 1)  # repeats one after the other are not neighbours
        least = _least_words(len(template), min_matched, min_coverage)
        found.sort()
        group = [found[0]]
        for item in [*found[1:], None]:
            if item is not None and item[0] - group[-1][0] <= band:
                group.append(item)
                continue
            for low, high, first, last in _regions(group, len(template), band):
                begin, end = max(0, first - len(template) - band), min(len(hashes), last + len(template) + band + GRAM)
                key = (owner, low - begin, high - begin, hashes[begin:end].tobytes())
                if key not in known:  # repeated lines of a text are aligned once
                    known[key] = align(template, hashes[begin:end], low - band - begin, high + band - begin)
                pairs = known[key]
                if len(pairs) >= least:
                    out.add((owner, len(pairs), pairs[0][1] + begin, pairs[-1][1] + begin))
            group = [item]
    return sorted(out)


def _regions(group, length, band):
    """Parts of a run of neighbouring diagonals: one per place in the text, no wider than the template allows."""
    group = sorted(group, key=lambda x: x[1])
    part = [group[0]]
    for item in [*group[1:], None]:
        if item is not None and item[1] - part[0][1] <= length + band and item[1] - part[-1][1] <= length:
            part.append(item)
            continue
        diagonals = [d for d, _ in part]
        yield min(diagonals), max(diagonals), part[0][1], part[-1][1]
        part = [item]


_INDEXES: dict = {}


def _index(templates: tuple, *least) -> Index:
    """One per worker process, set of templates and least match."""
    if (templates, *least) not in _INDEXES:
        _INDEXES[templates, *least] = Index(dict(templates), *least)
    return _INDEXES[templates, *least]


def scan_licenses(df: DataFrame, templates=TEMPLATES, id="doc_id", text="text", min_matched=MIN_MATCHED,
                  min_coverage=MIN_COVERAGE) -> DataFrame:
    """id, template, matched and template words, coverage, and the span in code points, a row per match."""
    fixed = tuple(templates.items())
    names = ["id", "template", "matched_words", "template_words", "coverage", "begin", "end"]

    def run(batches):
        index = _index(fixed, min_matched, min_coverage)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows = []
            for i, j in row_blocks(offsets, BLOCK_BYTES):
                own, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                words = Words(_LOWER[own], at, with_runs=False)
                first = np.cumsum(words.per_row) - words.per_row
                row = np.repeat(np.arange(j - i), words.per_row)
                letters = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])  # code points before each byte
                hits: dict[int, list] = {int(r): [] for r in index.rows_with_short(words.hash, row)}
                g = grams(words.hash)
                whole = np.flatnonzero(row[:len(g)] == row[len(row) - len(g):])  # inside one text
                g, row = g[whole], row[whole]
                kept = winnow(g, row)
                for n, owner, place in index.postings(g[kept]):
                    r = int(row[kept[n]])
                    hits.setdefault(r, []).append((int(whole[kept[n]]) - int(first[r]), owner, place))
                for r, found in hits.items():
                    inside = slice(int(first[r]), int(first[r] + words.per_row[r]))
                    starts, lengths = words.starts[inside], words.lengths[inside]
                    for owner, matched, a, b in matches(index, words.hash[inside], found, min_matched, min_coverage):
                        span = [int(letters[x] - letters[at[r]]) for x in (starts[a], starts[b] + lengths[b])]
                        rows.append((i + r, index.names[owner], matched, len(index.words[owner]), matched / len(index.words[owner]), *span))
            if rows:
                where, *columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(where)), pa.array(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:3]),
                    pa.array(columns[3], pa.float64()), *(pa.array(c, pa.int64()) for c in columns[4:])], names=names)

    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(rows, run, f"id {dict(rows.dtypes)['id']}, template string, matched_words long, template_words long, coverage double, begin long, end long")


def op8_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
