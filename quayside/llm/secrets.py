"""Secret scans: fixed patterns, and a small character convolutional network.

The base patterns find assignments, access keys and long hexadecimal strings.
Every other candidate, a run of 16 or more token characters with a digit and a
letter, is shown to the network with the characters around it; a long one in
windows that overlap, of which the greatest score counts. The network is
trained on all labelled findings: base findings are secrets, candidates that no
pattern takes are not. Many findings are dealt over shards, each of which learns
for an epoch from its own, after which the weights are averaged. The scores are
calibrated on findings the network did not learn from, and its threshold is the
highest that keeps the wanted recall there, but never one that flags more
ordinary candidates than allowed.

Defined results: a null or empty text has no spans. Without findings of both
kinds to learn from, only the base patterns speak. Repeated rows get equal
spans. Texts are read whole; offsets count code points, ends are exclusive.
Result columns replace columns of the same name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import discard, free_name, kept

#: Labelled findings that are learned from in one place; more are dealt over shards of as many, or over the most shards.
SHARD, SHARDS = 3000, 64
EPOCHS = 25
#: Logits are counted in steps of this size.
BIN = 1e-3
#: Share of the calibration secrets that the threshold keeps, and of the others that it may flag.
RECALL, FALSE_ALARMS = 0.98, 0.001
#: A candidate below this calibrated score is not reported unless recall needs it.
LEAST_SCORE = 0.8

#: The base patterns, the least length of what they take, and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "learned")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_HEX_BYTES = bytes(120 if chr(i) in "0123456789abcdef" else 46 for i in range(256))

# A window shows a part of a candidate, what stands before that part, and what stands behind it. Parts of a long
# candidate begin a step apart, and the last one ends with it.
BEFORE, INSIDE, BEHIND, STEP = 24, 40, 12, 20
SIZE = BEFORE + INSIDE + BEHIND
WIDTH, FILTERS = 5, 24
#: Character classes: a to z, A to Z, 0 to 9, then these, then any other; 0 pads. Behind a candidate they are classes
#: of their own, so that a keyword there is not taken for one before it.
MARKS = " \"'=:+/_.-,;()@|"
CLASSES = 64 + len(MARKS)
ALPHABET = 2 * CLASSES


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base findings by start, then kind. Cheap tests for a keyword or a long run come first."""
    found = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"x" * 24 in text.encode("utf-8", "replace").translate(_HEX_BYTES):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Token runs with a digit and a letter that touch no base finding."""
    if not any(len(w) >= 16 for w in text.split()):
        return []
    out = []
    for m in CANDIDATE.finditer(text):
        token = m[0]
        if any(c.isdigit() for c in token) and any(c.isalpha() for c in token):
            if all(m.end() <= start or end <= m.start() for _, start, end in taken):
                out.append(m.span())
    return out


def _code_table() -> np.ndarray:
    table = np.full(0x110000, 63, np.uint8)
    for i, char in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
        table[ord(char)] = i + 1
    for i, char in enumerate(MARKS):
        table[ord(char)] = 64 + i
    return table


_CODES: np.ndarray | None = None


def window(text: str, start: int, end: int, at: int = 0) -> bytes:
    """The codes of the part of a candidate from ``at`` on, and of what stands before and behind it, padded to one size."""
    global _CODES
    if _CODES is None:
        _CODES = _code_table()
    first = start + at
    stop = min(end, first + INSIDE)
    before, shown = text[max(0, first - BEFORE) : first], text[first : min(end, stop + BEHIND)]
    behind = text[end : end + BEHIND - (len(shown) - (stop - first))]
    codes = _CODES[np.frombuffer((before + shown + behind).encode("utf-32-le", "surrogatepass"), np.uint32)]
    out = np.zeros(SIZE, np.uint8)
    out[BEFORE - len(before) : BEFORE + len(shown) + len(behind)] = codes
    out[BEFORE + len(shown) : BEFORE + len(shown) + len(behind)] += CLASSES
    return out.tobytes()


def windows_of(text: str, start: int, end: int) -> list[bytes]:
    """Windows that show a candidate whole."""
    last = max(0, end - start - INSIDE)
    return [window(text, start, end, at) for at in [*range(0, last, STEP), last]]


@dataclass
class SecretModel:
    """Convolution over one-hot characters, the greatest response of each filter, a logistic answer, calibrated."""

    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.1

    def responses(self, codes: np.ndarray) -> np.ndarray:
        steps = codes.shape[1] - WIDTH + 1
        total = np.zeros((len(codes), steps, FILTERS), np.float32)
        for k in range(WIDTH):
            total += self.filters[k][codes[:, k : k + steps]]
        return np.maximum(total + self.bias, 0)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return self.responses(codes).max(1) @ self.out + self.out_bias

    def scores(self, windows: list[bytes]) -> np.ndarray:
        out = []
        for start in range(0, len(windows), 512):
            part = windows[start : start + 512]
            codes = np.frombuffer(b"".join(part), np.uint8).reshape(len(part), -1)
            out.append(1 / (1 + np.exp(-np.clip(self.scale * self.logits(codes) + self.shift, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def _new_model(random: np.random.Generator) -> SecretModel:
    return SecretModel(
        random.normal(0, 0.2, (WIDTH, ALPHABET, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        random.normal(0, 0.2, FILTERS).astype(np.float32),
        0.0,
    )


def _new_state(model: SecretModel) -> list[list[np.ndarray]]:
    """The moments of Adam."""
    return [[np.zeros_like(p), np.zeros_like(p)] for p in (model.filters, model.bias, model.out, np.zeros(()))]


def _epoch(model: SecretModel, state: list, step: int, codes: np.ndarray, labels: np.ndarray, weigh: np.ndarray, learn: np.ndarray) -> int:
    """Mini-batches with Adam over the findings in the order of ``learn``."""
    for start in range(0, len(learn), 64):
        batch = learn[start : start + 64]
        x, step = codes[batch], step + 1
        response = model.responses(x)
        where = response.argmax(1)
        top = np.take_along_axis(response, where[:, None], 1)[:, 0]
        logit = np.clip(top @ model.out + model.out_bias, -30, 30)
        pull = (weigh[batch] * (1 / (1 + np.exp(-logit)) - labels[batch]) / len(batch)).astype(np.float32)
        back = pull[:, None] * model.out * (top > 0)
        grad = np.zeros_like(model.filters)
        for k in range(WIDTH):
            letters = np.take_along_axis(x, where + k, 1)
            np.add.at(grad[k], (letters, np.arange(FILTERS)), back)
        grads = (grad + 1e-4 * model.filters, back.sum(0), top.T @ pull + 1e-3 * model.out, pull.sum())
        moved = []
        for (m, v), g in zip(state, grads, strict=True):
            m[...] = 0.9 * m + 0.1 * g
            v[...] = 0.999 * v + 0.001 * np.square(g)
            moved.append(0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7))
        model.filters -= moved[0]
        model.bias -= moved[1]
        model.out -= moved[2]
        model.out_bias -= float(moved[3])
    return step


def _calibrate(model: SecretModel, logits: np.ndarray, truth: np.ndarray, times: np.ndarray | None = None) -> None:
    """Scale and shift of the logits by their likelihood; a logit may stand for several."""
    for _ in range(300):
        error = 1 / (1 + np.exp(-np.clip(model.scale * logits + model.shift, -30, 30))) - truth
        model.scale = max(0.05, model.scale - 0.02 * float(np.average(error * logits, weights=times)))
        model.shift -= 0.1 * float(np.average(error, weights=times))


def _set_threshold(model: SecretModel, keeps_recall: float, few_alarms: float) -> None:
    logit = np.log(np.clip([keeps_recall, few_alarms], 1e-9, 1 - 1e-9) / (1 - np.clip([keeps_recall, few_alarms], 1e-9, 1 - 1e-9)))
    model.threshold = float(min(keeps_recall, max(LEAST_SCORE, 1 / (1 + np.exp(-logit.mean())))))


def train(codes: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> SecretModel | None:
    """Findings of one place; every fifth is kept apart for calibration and for the threshold."""
    if len(labels) < 20 or labels.min() == labels.max():
        return None
    random = np.random.default_rng(11)
    order = random.permutation(len(labels))
    apart, learn = order[::5], np.setdiff1d(order, order[::5])
    if len({*labels[apart]}) < 2 or len({*labels[learn]}) < 2:
        return None
    model = _new_model(random)
    weigh = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    state, step = _new_state(model), 0
    for _ in range(epochs):
        learn = random.permutation(learn)
        step = _epoch(model, state, step, codes, labels, weigh, learn)
    logits, truth = model.logits(codes[apart]), labels[apart]
    _calibrate(model, logits, truth)
    scores = model.scores([codes[i].tobytes() for i in apart])
    keeps_recall = np.quantile(scores[truth > 0], 1 - RECALL, method="lower")
    few_alarms = np.quantile(scores[truth == 0], 1 - FALSE_ALARMS, method="higher")
    _set_threshold(model, keeps_recall, few_alarms)
    return model


def _flat(model: SecretModel, state: list) -> np.ndarray:
    """All weights and moments in a row."""
    parts = [model.filters, model.bias, model.out, np.array(model.out_bias), *(x for pair in state for x in pair)]
    return np.concatenate([np.ravel(p) for p in parts]).astype(np.float32)


def _unflat(row: np.ndarray) -> tuple[SecretModel, list]:
    model = _new_model(np.random.default_rng(0))
    state = _new_state(model)
    at = 0

    def part(like: np.ndarray) -> np.ndarray:
        nonlocal at
        at += like.size
        return row[at - like.size : at].reshape(like.shape).copy()

    model.filters, model.bias, model.out, model.out_bias = part(model.filters), part(model.bias), part(model.out), float(part(np.zeros(())))
    return model, [[part(m), part(v)] for m, v in state]


def _codes(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), SIZE)


def _quantile(logits: np.ndarray, times: np.ndarray, share: float, higher: bool) -> float:
    """The quantile of sorted logits that stand for several each: the observed one below the share, or above it."""
    ends = np.cumsum(times)
    place = share * (ends[-1] - 1)
    place = np.ceil(place) if higher else np.floor(place)
    return float(logits[np.searchsorted(ends, place, side="right")])


def train_dealt(found: DataFrame, shards: int, epochs: int = EPOCHS) -> SecretModel | None:
    """The network of findings (codes, label) that are dealt over shards by their hash; a fifth is kept apart, also by hash.

    What reaches the driver is a set of weights per shard and epoch, and the counts of logits by label and step.
    """
    apart = F.pmod(F.xxhash64("codes", F.lit("apart")), F.lit(5)) == 0
    dealt = found.withColumns({"shard": F.pmod(F.xxhash64("codes"), F.lit(shards)), "apart": apart})
    sizes = {(r.apart, r.label): r["count"] for r in dealt.groupBy("apart", "label").count().collect()}
    if len(sizes) < 4:
        return None
    share = sum(n for (_, label), n in sizes.items() if label) / sum(sizes.values())
    own = dealt.where(~F.col("apart")).repartition(shards, "shard").groupBy("shard")
    own = kept(own.agg(F.sort_array(F.collect_list(F.struct("codes", "label"))).alias("rows")), "secret-shards")
    model = _new_model(np.random.default_rng(11))
    weights, step = _flat(model, _new_state(model)), 0

    def learned(epoch: int, weights: np.ndarray, step: int):
        def learn(batches):
            for batch in batches:
                for shard, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    codes, labels = _codes(rows.values.field(0).to_pylist()), rows.values.field(1).to_numpy()
                    model, state = _unflat(weights)
                    weigh = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
                    order = np.random.default_rng([11, epoch, shard]).permutation(len(labels))
                    last = _epoch(model, state, step, codes, labels, weigh, order)
                    columns = [pa.array([shard], pa.int64()), pa.array([len(labels)], pa.int64()), pa.array([last], pa.int64())]
                    columns.append(pa.array([_flat(model, state).tobytes()], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "n", "step", "weights"])

        return own.mapInArrow(learn, "shard long, n long, step long, weights binary").collect()

    for epoch in range(epochs):
        rows = sorted(learned(epoch, weights, step), key=lambda r: r.shard)
        n = [r.n for r in rows]
        weights = np.average([np.frombuffer(r.weights, np.float32) for r in rows], axis=0, weights=n).astype(np.float32)
        step = max(1, round(float(np.average([r.step for r in rows], weights=n))))
    model, _ = _unflat(weights)

    def counted(batches):
        for batch in batches:
            windows = batch.column(0).to_pylist()
            logits = [model.logits(_codes(windows[i : i + 512])) for i in range(0, len(windows), 512)]
            steps = np.floor(np.clip(np.concatenate(logits), -1e6, 1e6) / BIN) if logits else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(steps.astype(np.int64)), batch.column(1)], names=["step", "label"])

    counts = dealt.where("apart").select("codes", "label").mapInArrow(counted, "step long, label int")
    rows = counts.groupBy("label", "step").count().orderBy("label", "step").collect()
    discard(own)
    steps, truth, times = (np.array([r[name] for r in rows]) for name in ("step", "label", "count"))
    _calibrate(model, (steps + 0.5) * BIN, truth, times)
    # A step's least logit keeps at least the wanted recall, its greatest flags at most the allowed share.
    least = _quantile(steps[truth > 0] * BIN, times[truth > 0], 1 - RECALL, higher=False)
    most = _quantile((steps[truth == 0] + 1) * BIN, times[truth == 0], 1 - FALSE_ALARMS, higher=True)
    _set_threshold(model, *(1 / (1 + np.exp(-np.clip(model.scale * np.array([least, most]) + model.shift, -30, 30)))))
    return model


def fit(docs: DataFrame, text: str = "text", shard: int = SHARD) -> SecretModel | None:
    """Fit on all findings; the executors cut the windows, and learn from them where there are more than one shard has."""

    def labelled(batches):
        for batch in batches:
            windows, labels = [], []
            for value in batch.column(0).to_pylist():
                if value:
                    taken = base_spans(value)
                    for kind, start, end in taken:
                        inner = ASSIGN.match(value, start, end) if kind == "assign" else None
                        windows += windows_of(value, inner.start(2) if inner else start, end)
                        labels += [1] * (len(windows) - len(labels))
                    for start, end in candidates(value, taken):
                        windows += windows_of(value, start, end)
                        labels += [0] * (len(windows) - len(labels))
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array(labels, pa.int32())], names=["codes", "label"])

    found = kept(docs.select(F.col(text)).mapInArrow(labelled, "codes binary, label int").distinct(), "secret-findings")
    n = found.count()
    if n > shard:
        model = train_dealt(found, min(SHARDS, -(-n // shard)))
    else:
        rows = found.orderBy("label", F.xxhash64("codes"), "codes").collect()
        model = train(_codes([r.codes for r in rows]), np.array([r.label for r in rows]))
    discard(found)
    return model


def _cut(text: str, rows: list[tuple[str, int, int]], mark: str) -> str:
    parts, done = [], 0
    for _, start, end in rows:
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def findings(model: SecretModel | None, text: Column, mark: str = "[SECRET]") -> Column:
    """A struct of all spans by start, then kind, and the text with a mark for each run of findings, null without findings."""

    @F.arrow_udf("spans array<struct<kind: string, start: int, end: int>>, redacted string")
    def find(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        found, open_rows, windows, begins = [], [], [], []
        for i, value in enumerate(texts):
            found.append(base_spans(value) if value else [])
            if value and model:
                for start, end in candidates(value, found[i]):
                    open_rows.append((i, start, end))
                    begins.append(len(windows))
                    windows += windows_of(value, start, end)
        if windows:
            greatest = np.maximum.reduceat(model.scores(windows), begins)
            for (i, start, end), score in zip(open_rows, greatest, strict=True):
                if score >= model.threshold:
                    found[i].append(("learned", start, end))
        found = [sorted(row, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) for row in found]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        spans = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in found], kind)
        cut = [_cut(value, row, mark) if row else None for value, row in zip(texts, found, strict=True)]
        return pa.StructArray.from_arrays([spans, pa.array(cut, pa.string())], names=["spans", "redacted"])

    return find.asNondeterministic()(text)


def scanned(docs: DataFrame, model: SecretModel | None, text: str = "text", into: str = "secret_spans") -> DataFrame:
    """The rows with their findings."""
    result = free_name(docs, "found", into)
    return docs.withColumn(result, findings(model, F.col(text))).withColumn(into, F.col(f"{result}.spans")).drop(result)


def redacted(docs: DataFrame, model: SecretModel | None, text: str = "text", length: str | None = None) -> DataFrame:
    """The rows with every finding replaced by a mark; overlapping findings become one. Other texts stay as they are.

    ``length`` names a column that has the number of characters, to be brought up to date where a text changes.
    """
    result = free_name(docs, "found")
    found = docs.withColumn(result, findings(model, F.col(text)))
    changed = {text: F.coalesce(f"{result}.redacted", text)}
    if length:
        changed[length] = F.coalesce(F.length(f"{result}.redacted").cast("long"), length)
    return found.withColumns(changed).drop(result)


def op10_secret_scans(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = scanned(docs, fit(docs), into="found")
    base = F.filter("found", lambda s: s["kind"] != KINDS[-1])

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(rows: Column) -> Column:
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *(count(k) for k in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
