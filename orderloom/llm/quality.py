"""Quality rules: a linear-chain conditional random field marks lines as content or boilerplate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import texts

# Bounds of the training sample: labelled documents, and windows of WINDOW_LINES lines of them.
SAMPLE_DOCS = 2000
SAMPLE_WINDOWS = 4000
WINDOW_LINES = 64
# Lines of the blocks that training puts from documents of one label into windows of the other.
BLOCK_LINES = (1, 1, 2, 3, 5, 10)
# A document is kept if at least this share of its words is in content lines.
CONTENT_SHARE = 0.5

REPEAT_WORDS = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CHARS = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a character
_UPPER, _DIGIT, _STOP, _MARK = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_STOP[list(b".,;:")] = True
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_MARK &= ~_STOP

FEATURES = 12
SCORES = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")
    ]
)


class Slice:
    """What the rules need to know of a slice of texts: counts by text and features by line."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        words, lines = texts.words(data, offsets), texts.lines(data, offsets)
        hashed = texts.hashes(data, words)
        self.n_words = words.per_text(n)
        in_word = self._sums(~texts._SPACE[data] & _CHARS[data])
        self.word_chars = in_word[offsets[1:]] - in_word[offsets[:-1]]
        symbols = self._sums(_SYMBOLS[data])
        self.n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]
        self.n_repeat_words = np.bincount(words.text[self._repeated(words, hashed)], minlength=n)

        line_of = np.searchsorted(lines.starts, words.starts, "right") - 1
        count = np.bincount(line_of, minlength=len(lines.starts))
        used = np.flatnonzero(count)
        lines = texts.Runs(lines.starts[used], lines.ends[used], lines.text[used])
        count = count[used]
        again = self._later_copies(texts.hashes(data, lines), lines.text)
        self.n_dup_lines = np.bincount(lines.text[again], minlength=n)

        self.line_text, self.line_words = lines.text, count
        self.first_line = np.searchsorted(lines.text, np.arange(n + 1))
        distinct, of = texts.distinct_per_text(hashed, line_of)
        distinct = np.bincount(of, minlength=len(self._all(line_of, used)))[used] if len(used) else count
        size = np.maximum(lines.ends - lines.starts, 1)
        share = lambda sums: (sums[lines.ends] - sums[lines.starts]) / size
        length = words.ends - words.starts
        spread = lambda values: np.bincount(line_of, values, minlength=used[-1] + 1 if len(used) else 0)[used]
        self.features = np.stack(
            [
                np.ones(len(used)),
                np.log1p(count) / 5,
                10 * share(symbols),
                5 * share(self._sums(_UPPER[data])),
                5 * share(self._sums(_DIGIT[data])),
                10 * share(self._sums(_STOP[data])),
                10 * share(self._sums(_MARK[data])),
                1 - distinct / count,
                again.astype(float),
                spread(length) / count / 10,
                (count <= 3).astype(float),
                spread(length <= 3) / count,
            ],
            axis=1,
        )

    @staticmethod
    def _all(line_of: np.ndarray, used: np.ndarray) -> range:
        return range(used[-1] + 1 if len(used) else 0)

    @staticmethod
    def _sums(flags: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])

    @staticmethod
    def _later_copies(hashed: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Lines equal to an earlier line of the same text."""
        order = np.lexsort((np.arange(len(text)), hashed, text))
        same = (hashed[order][1:] == hashed[order][:-1]) & (text[order][1:] == text[order][:-1])
        again = np.zeros(len(text), bool)
        again[order[1:][same]] = True
        return again

    @staticmethod
    def _repeated(words: texts.Runs, hashed: np.ndarray) -> np.ndarray:
        """Words in windows of five that the text holds twice or more."""
        window, first = texts.shingles(hashed, words.text, REPEAT_WORDS)
        key = texts.mix(window + words.text[first].astype(np.uint64))
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        hit = first[times[which] > 1]
        edge = np.zeros(len(hashed) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + REPEAT_WORDS, -1)
        return np.cumsum(edge[:-1]) > 0


class LineField:
    """A two-state chain over lines: state 1 is content, state 0 boilerplate."""

    def __init__(self, weights=None, steps=None, start: float = 0.0):
        self.weights = np.zeros(FEATURES) if weights is None else weights
        self.steps = np.zeros((2, 2)) if steps is None else steps
        self.start = start

    def content(self, emission: list[float]) -> list[bool]:
        """The most likely states; a tie is content."""
        (bb, bc), (cb, cc) = self.steps.tolist()
        boiler, content = 0.0, self.start + emission[0]
        back = []
        for e in emission[1:]:
            to_b, to_c = content + cb >= boiler + bb, content + cc >= boiler + bc
            boiler, content = (
                content + cb if to_b else boiler + bb,
                (content + cc if to_c else boiler + bc) + e,
            )
            back.append((to_b, to_c))
        state = content >= boiler
        states = [state]
        for step in reversed(back):
            state = step[state]
            states.append(state)
        return states[::-1]

    @classmethod
    def fit(cls, features: list[np.ndarray], labels: list[np.ndarray], passes: int = 200) -> LineField:
        """Maximum likelihood with a quadratic penalty; ``labels`` has one for each line of a window.

        Without lines of both labels all lines are content.
        """
        if len({int(y) for own in labels for y in own}) < 2:
            return cls()
        longest = max(map(len, features))
        x = np.zeros((len(features), longest, FEATURES))
        mask = np.zeros((len(features), longest))
        for k, rows in enumerate(features):
            x[k, : len(rows)], mask[k, : len(rows)] = rows, 1
        y = np.zeros(mask.shape)
        for k, own in enumerate(labels):
            y[k, : len(own)] = own
        last = mask.sum(1).astype(int) - 1
        both = mask[:, 1:]
        # Observed steps from one line to the next.
        now, then = np.stack([1 - y[:, :-1], y[:, :-1]], -1), np.stack([1 - y[:, 1:], y[:, 1:]], -1)
        seen = (now[..., :, None] * then[..., None, :] * both[..., None, None]).sum(1)
        theta = np.zeros(FEATURES + 5)
        first_moment, second_moment = np.zeros_like(theta), np.zeros_like(theta)
        for k in range(1, passes + 1):
            w, steps, start = theta[:FEATURES], theta[FEATURES:-1].reshape(2, 2), theta[-1]
            emit = np.stack([np.zeros(mask.shape), x @ w], -1)
            emit[:, 0, 1] += start
            ahead = np.zeros(emit.shape)
            ahead[:, 0] = emit[:, 0]
            for t in range(1, longest):
                step = np.logaddexp(ahead[:, t - 1, :1] + steps[0], ahead[:, t - 1, 1:] + steps[1])
                ahead[:, t] = step + emit[:, t]
            behind = np.zeros(emit.shape)
            for t in range(longest - 2, -1, -1):
                after = behind[:, t + 1] + emit[:, t + 1]
                step = np.logaddexp(steps[:, 0] + after[:, :1], steps[:, 1] + after[:, 1:])
                behind[:, t] = np.where((t < last)[:, None], step, 0)
            ends = ahead[np.arange(len(y)), last]
            total = np.logaddexp(ends[:, 0], ends[:, 1])
            content = np.exp(ahead[..., 1] + behind[..., 1] - total[:, None]) * mask
            pair = ahead[:, :-1, :, None] + steps + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]
            pair = np.exp(np.where(both[..., None, None] > 0, pair, -np.inf)).sum((1,))
            missing = mask * y - content
            gradient = np.concatenate(
                [np.einsum("nt,ntf->f", missing, x), (seen - pair).sum(0).ravel(), [(y[:, 0] - content[:, 0]).sum()]]
            )
            gradient = gradient / len(y) - 1e-3 * theta
            first_moment = 0.9 * first_moment + 0.1 * gradient
            second_moment = 0.999 * second_moment + 0.001 * gradient**2
            theta = theta + 0.1 * (first_moment / (1 - 0.9**k)) / (np.sqrt(second_moment / (1 - 0.999**k)) + 1e-8)
        return cls(theta[:FEATURES], theta[FEATURES:-1].reshape(2, 2), float(theta[-1]))


def train(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> LineField:
    """Fit on a bounded sample of labelled documents, whole texts, lines labelled as their document.

    A document has one label, so its windows alone would teach the field never to change its state. Each
    window is therefore learnt from with blocks of the other label put into it (see ``spliced``): the
    seams are known, and are where the field learns its steps.

    The sample is the ``SAMPLE_DOCS`` labels whose identifiers have the lowest hashes and, of their
    lines, at most ``SAMPLE_WINDOWS`` windows of ``WINDOW_LINES``, so reruns agree. Labels other
    than 0 and 1, null identifiers and labels without a document are left out. Where an identifier has
    several labels or documents, each pair of them counts, contradicting ones too.
    """
    few = (
        labels.select(F.col(id_column).alias("id"), F.col("quality").cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(SAMPLE_DOCS)
    )
    held = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    # At most SAMPLE_DOCS pairs of numbers.
    sample = held.join(F.broadcast(few), "id")
    windows = (
        sample.mapInArrow(_windows, "id long, label int, at int, features array<float>")
        .orderBy(F.xxhash64("id", "at"), "id", "at", "label")
        .limit(SAMPLE_WINDOWS)
        .collect()
    )
    features = [np.array(w.features).reshape(-1, FEATURES) for w in windows]
    return LineField.fit(*spliced(features, [w.label for w in windows]))


def spliced(features: list[np.ndarray], labels: list[int], seed: int = 5) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each window with a block of lines from a window of the other label at its start, middle or end, and its line labels.

    Blocks have up to ``BLOCK_LINES`` lines in a row. Every third window stays as it is. Windows of one
    label only stay as they are.
    """
    draw = np.random.default_rng(seed)
    of = [[k for k, y in enumerate(labels) if y == label] for label in (0, 1)]
    rows, marks = [], []
    for k, (own, label) in enumerate(zip(features, labels)):
        mark = np.full(len(own), label)
        others = of[1 - label]
        if others and k % 3:
            other = features[others[draw.integers(len(others))]]
            size = min(len(other), int(draw.choice(BLOCK_LINES)))
            begin = draw.integers(len(other) - size + 1)
            at = (0, len(own), int(draw.integers(len(own) + 1)))[draw.integers(3)]
            own = np.concatenate([own[:at], other[begin : begin + size], own[at:]])
            mark = np.concatenate([mark[:at], np.full(size, 1 - label), mark[at:]])
        rows.append(own)
        marks.append(mark)
    return rows, marks


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        ids, labels, at, features = [], [], [], []
        for data, offsets in texts.slices(batch.column("text")):
            part = Slice(data, offsets)
            for k in range(len(offsets) - 1):
                rows = part.features[part.first_line[k] : part.first_line[k + 1]]
                for a in range(0, len(rows), WINDOW_LINES):
                    ids.append(batch.column("id")[done + k].as_py())
                    labels.append(batch.column("label")[done + k].as_py())
                    at.append(a)
                    features.append(rows[a : a + WINDOW_LINES].ravel())
            done += len(offsets) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(labels, pa.int32()),
                pa.array(at, pa.int32()),
                pa.array(features, pa.list_(pa.float32())),
            ],
            ["id", "label", "at", "features"],
        )


def scores(text: Column, model: LineField) -> Column:
    """A struct of counts for each whole text.

    Words are runs other than space and 0x09-0x0D; ``n_dup_lines`` counts lines with a word that
    equal an earlier line; ``n_repeat_words`` words in five-word windows found twice or more;
    ``content_words`` words in lines that the field marks as content. Null and empty texts have 0
    of everything.
    """

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in SCORES.names]
            for data, offsets in texts.slices(batch):
                part = Slice(data, offsets)
                emission = (part.features @ model.weights).tolist()
                first = part.first_line.tolist()
                states = []
                for a, b in zip(first, first[1:]):
                    states += model.content(emission[a:b]) if b > a else []
                good = np.bincount(
                    part.line_text, part.line_words * np.array(states, bool), minlength=len(first) - 1
                )
                counts = (part.n_words, part.word_chars, part.n_symbols, part.n_dup_lines, part.n_repeat_words, good)
                for column, values in zip(parts, counts):
                    column.append(values.astype(np.int64))
            columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in parts]
            yield pa.StructArray.from_arrays(columns, SCORES.names)

    return F.arrow_udf(score, SCORES)(text)


def judge(documents: DataFrame, model: LineField, text: str = "text", into: str = "quality") -> DataFrame:
    """Add a struct ``into`` with the counts of ``scores``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 10 words, or over 20% of the words in repeated windows. Kept are
    the other documents with at least ``CONTENT_SHARE`` of their words in content lines. All rows
    and columns stay, repeated rows too; a column named like ``into`` is replaced.
    """
    scored = documents.withColumn(into, scores(F.col(text), model))
    n, repeated = F.col(f"{into}.n_words"), F.col(f"{into}.n_repeat_words")
    failed = (n < 10) | (100 * repeated > 20 * n)
    content = F.col(f"{into}.content_words") >= CONTENT_SHARE * n
    return scored.withColumn(
        into, F.col(into).withField("base_failed", failed).withField("kept", ~failed & content)
    )
