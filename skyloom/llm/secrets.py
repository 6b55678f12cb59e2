"""Secret scans: rules, and a character convolutional network in numpy over what they leave.

The rules give the base findings. Every other long run of key characters with a digit is a
candidate. The network reads the candidate with the text around it, in tiles if it is long, and
is trained on labelled findings of all documents: those of the rules, generated ones of known
kinds, found and clean, and candidates that no rule finds and that a first network takes for
clean. The examples are dealt to parts, each with generated ones of its own; in every round each
part trains a copy of the network, and the copies are averaged (McMahan et al., 2017). Outputs
are calibrated on examples held back, and the threshold is the highest that keeps the recall
asked for there.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import local, query, table, unused
from skyloom.sources.lake import staged

PART = 4_000
PER_LABEL = 2_000
RECALL = 0.97
FLOOR = 0.5
SHORTEST = 16
TILE, AROUND = 64, 16
EMBED, WIDTH, FILTERS = 8, 5, 24
EPOCHS, ROUNDS, BATCH, RATE = 12, 4, 64, 3e-3
#: Outputs are told apart in steps of 1 / STEPS; weights are averaged in units of 1 / UNITS.
STEPS, UNITS = 1024, 1 << 24
SEED = 5
REPLACEMENT = "[SECRET]"
KINDS = ["assign", "access", "hex", "learned"]

# The base rules, as given; the least length is of the group named.
RULES = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
]
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{SHORTEST},}}")
DIGIT = re.compile(r"[0-9]")


def base_findings(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of the rules' matches, by start and kind."""
    found = []
    for kind, rule, group, least in RULES:
        for m in rule.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((kind, m.start(), m.end(), m.start(group)))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def candidates(text: str, found: list) -> list[tuple[int, int]]:
    """Runs of key characters with a digit that no base finding touches."""
    taken, out, i = sorted((f[1], f[2]) for f in found), [], 0
    for m in CANDIDATE.finditer(text):
        if not DIGIT.search(m.group()):
            continue
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if not any(start < m.end() and m.start() < end for start, end in taken[i:]):
            out.append(m.span())
    return out


def tiles(text: str, start: int, end: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Symbols and candidate mask of the tiles of one candidate with the text around each."""
    return [tile(text, at, start, end) for at in range(start, end, TILE)]


def tile(text: str, at: int, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = at - AROUND, at + TILE + AROUND
    piece = text[max(0, low) : high]
    code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    symbols = np.zeros(high - low, np.int64)
    left = max(0, -low)
    symbols[left : left + len(code)] = np.where((code >= 32) & (code < 127), code - 31, 96)
    place = np.arange(low, high)
    return symbols, (place >= start) & (place < end)


class Network:
    """Embedding, convolution, ReLU, greatest value over the tile and over the candidate, and a
    linear output."""

    def __init__(self, rng: np.random.Generator):
        self.p = {
            "e": rng.normal(0, 0.3, (97, EMBED)),
            "w": rng.normal(0, np.sqrt(2 / (WIDTH * (EMBED + 1))), (WIDTH * (EMBED + 1), FILTERS)),
            "b": np.zeros(FILTERS),
            "v": rng.normal(0, 0.1, 2 * FILTERS),
            "c": np.zeros(1),
        }

    def forward(self, symbols: np.ndarray, mask: np.ndarray):
        p = self.p
        x = np.concatenate([p["e"][symbols], mask[:, :, None].astype(float)], axis=2)
        n = x.shape[1] - WIDTH + 1
        windows = np.concatenate([x[:, k : k + n] for k in range(WIDTH)], axis=2)
        h = np.maximum(windows @ p["w"] + p["b"], 0)
        inside = mask[:, WIDTH // 2 : WIDTH // 2 + n]
        all_at, own_at = h.argmax(axis=1), np.where(inside[:, :, None], h, -1.0).argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(h, a[:, None, :], 1)[:, 0] for a in (all_at, own_at)], axis=1)
        return pooled @ p["v"] + p["c"][0], (windows, h, all_at, own_at, pooled, symbols)

    def gradient(self, cache, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Of the sum of outputs times ``slope``."""
        windows, h, all_at, own_at, pooled, symbols = cache
        p, back = self.p, np.zeros_like(h)
        rows, cols = np.arange(len(h))[:, None], np.arange(FILTERS)[None, :]
        for i, at in enumerate((all_at, own_at)):
            back[rows, at, cols] += slope[:, None] * p["v"][None, i * FILTERS : (i + 1) * FILTERS]
        back *= h > 0
        wide = back @ p["w"].T
        e = np.zeros_like(p["e"])
        n = h.shape[1]
        for k in range(WIDTH):
            part = wide[:, :, k * (EMBED + 1) : k * (EMBED + 1) + EMBED]
            np.add.at(e, symbols[:, k : k + n], part)
        return {
            "e": e,
            "w": np.tensordot(windows, back, axes=([0, 1], [0, 1])),
            "b": back.sum(axis=(0, 1)),
            "v": pooled.T @ slope,
            "c": np.array([slope.sum()]),
        }


def outputs(network: Network, symbols: np.ndarray, mask: np.ndarray) -> np.ndarray:
    parts = [network.forward(symbols[i : i + 256], mask[i : i + 256])[0] for i in range(0, len(symbols), 256)]
    found = np.concatenate(parts) if parts else np.zeros(0)
    return np.rint(np.clip(found, -50, 50) * STEPS) / STEPS


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def trained(
    symbols: np.ndarray, mask: np.ndarray, y: np.ndarray, rng: np.random.Generator, weights: dict | None = None, epochs: int = EPOCHS
) -> Network:
    """Adam on the logistic loss, both labels weighted alike, from ``weights`` if given."""
    network = Network(rng)
    if weights:
        network.p = {k: v.copy() for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            i = order[at : at + BATCH]
            out, cache = network.forward(symbols[i], mask[i])
            slopes = network.gradient(cache, weight[i] * (sigmoid(out) - y[i]) / len(i))
            step += 1
            for k, g in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                network.p[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return network


def calibration(out: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic of the outputs (Platt, 1999), by Newton's method; ``n`` is
    how often an output and label occur."""
    x = np.column_stack([out, np.ones(len(out))])
    ones, zeros = n @ y, n @ (1 - y)
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(x @ w)
        w = w + np.linalg.solve((x * (n * (p * (1 - p) + 1e-6))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (n * (target - p)))
    return float(w[0]), float(w[1])


def quantile(values: np.ndarray, n: np.ndarray, share: float) -> float:
    """The value at ``share`` of those in order, each there ``n`` times; the lower of two."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(n[order])
    return float(values[order][np.searchsorted(upto, int(np.floor((upto[-1] - 1) * share)), side="right")])


def generated(rng: np.random.Generator, count: int) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of ``count`` findings of each label: keys in code and prose;
    numbers, names, addresses, paths and versions."""
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    upper = lower.upper()

    def some(letters: str, low: int, high: int) -> str:
        return "".join(rng.choice(list(letters), rng.integers(low, high + 1)))

    def word() -> str:
        return some(lower, 2, 9)

    keys = [
        lambda: some("0123456789abcdef", 16, 64),
        lambda: some("0123456789ABCDEF", 16, 64),
        lambda: some(lower + upper + digits, 16, 64),
        lambda: some(lower + upper + digits + "+/", 20, 88) + "=" * int(rng.integers(0, 3)),
        lambda: "AKIA" + some(upper + digits, 16, 16),
        lambda: "_".join([some(lower, 2, 4), some(lower, 4, 4), some(lower + upper + digits, 16, 36)]),
        lambda: ".".join(some(lower + upper + digits + "_-", 16, 40) for _ in range(3)),
    ]
    plain = [
        lambda: some(digits, 16, 19),
        lambda: some(digits, 16, 16),
        lambda: "-".join([some(digits, 4, 4) for _ in range(4)]),
        lambda: f"mail{some(digits, 1, 2)}.{word()}.{word()}.com",
        lambda: f"www.{word()}{some(digits, 1, 2)}.{word()}.org/{word()}/{word()}",
        lambda: f"/{word()}/{word()}/{word()}{some(digits, 1, 3)}.{some(lower, 2, 3)}",
        lambda: f"{word()}-{word()}-{some(digits, 1, 3)}.{some(digits, 1, 2)}.{some(digits, 1, 2)}",
        lambda: f"20{some(digits, 2, 2)}-{some(digits, 2, 2)}-{some(digits, 2, 2)}-{word()}-{word()}",
        lambda: f"{word()}_{word()}_{word()}_{some(digits, 1, 2)}",
        lambda: some(lower, 16, 28) + some(digits, 1, 2),
        lambda: str(rng.choice(list(lower + digits))) * int(rng.integers(16, 40)) + "0",
    ]
    before = ['key = "', "auth: ", "Bearer ", "PRIVATE=", 'credential="', "pw ", ""]
    out = []
    for label, makers in ((1, keys), (0, plain)):
        made = 0
        while made < count:
            value = makers[rng.integers(len(makers))]()
            if len(value) < SHORTEST or not DIGIT.search(value):
                continue
            lead = " ".join(word() for _ in range(rng.integers(0, 4)))
            lead += " " + (before[rng.integers(len(before))] if label and rng.random() < 0.7 else "")
            text = lead + value + rng.choice([" ", '" ', ". ", ", "]) + " ".join(word() for _ in range(3))
            out.append((text, len(lead), len(lead) + len(value), label))
            made += 1
    return out


#: Labels of examples; the last is of candidates, which the first network sorts.
CLEAN, SECRET, OPEN = 0, 1, 2


def examples(docs: DataFrame) -> DataFrame:
    """Stored different examples of every text: label, symbols of the first tile, and the place in
    it where the value ends."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = base_findings(text)
                spans = [(f[3], f[2], SECRET) for f in found if f[0] != "assign" or f[2] - f[3] >= SHORTEST]
                spans += [(*span, OPEN) for span in candidates(text, found)]
                out += [example(text, *span) for span in spans]
            yield pd.DataFrame(out, columns=["label", "symbols", "high"])

    texts = docs.select("text").filter("text != ''")
    return staged(texts.mapInPandas(task, "label int, symbols binary, high int").distinct(), "secret_examples")


def example(text: str, start: int, end: int, label: int) -> tuple[int, bytes, int]:
    symbols, _ = tile(text, start, start, end)
    return label, symbols.astype(np.uint8).tobytes(), min(AROUND + end - start, len(symbols))


def dealt(every: DataFrame) -> DataFrame:
    """Stored parts of about PART ``examples``, each one row, to which PER_LABEL generated ones of
    each label come; some of all are held back."""
    many = max(1, -(-every.count() // PART))
    rows = every.withColumn("part", F.pmod(F.xxhash64("symbols", "high"), F.lit(many)))
    numbers = every.sparkSession.range(many).withColumnRenamed("id", "part")  # a part may be empty

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["part"].iloc[0])
        rng = np.random.default_rng([SEED, number])
        own = [example(*made) for made in generated(rng, PER_LABEL)]
        own += sorted(rows[["label", "symbols", "high"]].dropna().astype({"label": int, "high": int}).itertuples(index=False, name=None))
        labels, symbols, highs = zip(*own)
        held = rng.random(len(own)) < 0.3
        blobs = (bytes(labels), b"".join(symbols), bytes(highs), held.tobytes())
        return pd.DataFrame([(number, *blobs)], columns=["part", "labels", "symbols", "highs", "held"])

    schema = "part long, labels binary, symbols binary, highs binary, held binary"
    together = rows.unionByName(numbers, allowMissingColumns=True).repartition(many, "part")
    return staged(together.groupBy("part").applyInPandas(pack, schema), "secret_parts")


def arrays(row, first: Network | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, masks, labels and which are held back, of a part. What no rule finds is taken for
    clean only where the first network agrees, and left out without one."""
    size = TILE + 2 * AROUND
    symbols, place = np.frombuffer(row.symbols, np.uint8).reshape(-1, size).astype(np.int64), np.arange(size)
    mask = (place >= AROUND) & (place < np.frombuffer(row.highs, np.uint8)[:, None])
    y, held = np.frombuffer(row.labels, np.uint8).astype(float), np.frombuffer(row.held, bool)
    kept, unknown = y != OPEN, np.flatnonzero(y == OPEN)
    if first and len(unknown):
        kept[unknown] = sigmoid(outputs(first, symbols[unknown], mask[unknown])) < 0.5
        y[unknown] = CLEAN
    return symbols[kept], mask[kept], y[kept], held[kept]


def fitted(parts: DataFrame, first: Network | None) -> Network:
    """A network of all examples, or of those not held back if there is a ``first`` one. Averages
    are of whole units, so that they do not depend on the order of parts."""
    network = Network(np.random.default_rng(SEED))
    shapes = {k: v.shape for k, v in network.p.items()}
    ends = np.cumsum([v.size for v in network.p.values()])
    for round in range(ROUNDS):

        def task(batches: Iterator[pd.DataFrame], round=round, weights=network.p) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    symbols, mask, y, held = arrays(row, first)
                    if first:
                        symbols, mask, y = symbols[~held], mask[~held], y[~held]
                    rng = np.random.default_rng([SEED, round, row.part])
                    own = trained(symbols, mask, y, rng, weights, EPOCHS // ROUNDS)
                    flat = np.concatenate([v.ravel() for v in own.p.values()] + [[1.0]])
                    yield pd.DataFrame({"units": [np.rint(flat * len(y) * UNITS).astype(np.int64)]})

        units = parts.mapInPandas(task, "units array<long>").select(F.posexplode("units").alias("at", "unit"))
        sums = np.array([r.s for r in units.groupBy("at").agg(F.sum("unit").alias("s")).orderBy("at").collect()], float)
        mean = np.split(sums[:-1] / sums[-1], ends[:-1])
        network = Network(np.random.default_rng(SEED))
        network.p = {k: v.reshape(shape) for (k, shape), v in zip(shapes.items(), mean)}
    return network


def learnt(docs: DataFrame) -> tuple[dict, float, float, float]:
    """Network weights, calibration and threshold, from all texts."""
    parts = dealt(examples(docs))
    first = fitted(parts, None)
    network = fitted(parts, first)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                symbols, mask, y, held = arrays(row, first)
                out = outputs(network, symbols[held], mask[held])
                yield pd.DataFrame({"step": np.rint(out * STEPS).astype(np.int64), "y": y[held].astype(np.int64)})

    # As many rows as there are steps and labels, however many examples.
    counts = local(parts.mapInPandas(task, "step long, y long").groupBy("step", "y").agg(F.count("*").alias("n")).orderBy("step", "y"))
    out, y, n = counts["step"].to_numpy() / STEPS, counts["y"].to_numpy().astype(float), counts["n"].to_numpy()
    slope, offset = calibration(out, y, n)
    least = quantile(sigmoid(slope * out[y == 1] + offset), n[y == 1], 1 - RECALL)
    return network.p, slope, offset, max(FLOOR, least)


FOUND = "array<struct<kind: string, start: int, end: int, value: int>>"


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (text, others) with ``findings`` (kind, start, end, start of the value; code
    points, end exclusive; by start, then kind) and ``redacted``, the text with every value
    replaced. Columns of these names in the input are replaced. Null and empty texts have no
    findings; a null text stays null."""
    docs = docs.drop("findings", "redacted")
    weights, slope, offset, least = learnt(docs)

    @F.pandas_udf(f"findings {FOUND}, redacted string")
    def task(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        network = Network(np.random.default_rng(0))
        network.p = weights
        for texts in batches:
            found = [base_findings(t) if t else [] for t in texts]
            spans, symbols, mask = [], [], []

            def settle():
                if not spans:
                    return
                chance = sigmoid(slope * outputs(network, np.stack(symbols), np.stack(mask)) + offset)
                best = {}
                for span, value in zip(spans, chance):
                    best[span] = max(best.get(span, 0.0), value)
                for (row, start, end), value in best.items():
                    if value >= least:
                        found[row].append(("learned", start, end, start))
                for held in (spans, symbols, mask):
                    held.clear()

            for row, text in enumerate(texts):
                for start, end in candidates(text, found[row]) if text else ():
                    for s, m in tiles(text, start, end):
                        spans.append((row, start, end))
                        symbols.append(s)
                        mask.append(m)
                if len(spans) >= 4096:
                    settle()
            settle()
            rows = [sorted(f, key=lambda f: (f[1], KINDS.index(f[0]))) for f in found]
            lists = [[dict(zip(("kind", "start", "end", "value"), f)) for f in row] for row in rows]
            # A text without findings is not sent back.
            clean = [redact(t, row) if row else None for t, row in zip(texts, rows)]
            yield pd.DataFrame({"findings": lists, "redacted": clean})

    # Nondeterministic only to the optimiser: its uses must not run it again.
    own = unused(docs, "_found")
    out = docs.withColumn(own, task.asNondeterministic()("text"))
    redacted = F.coalesce(f"{own}.redacted", "text").alias("redacted")
    return out.select(*docs.columns, F.col(f"{own}.findings").alias("findings"), redacted)


def redact(text: str, found: list[tuple[str, int, int, int]]) -> str:
    """The text with the values of all findings replaced; overlapping ones once."""
    out, at = [], 0
    for start, end in sorted((f[3], f[2]) for f in found):
        if start >= at:
            out += [text[at:start], REPLACEMENT]
        at = max(at, end)
    return "".join(out) + text[at:]


def listed(findings: Column) -> Column:
    """kind:start:end of each, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def of_kind(findings: Column, kind: str) -> Column:
    return F.filter(findings, lambda f: f["kind"] == kind)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: those of the rules, and those the network adds."""
    found = scan(table(spark, sf_dir, "documents"))
    every = F.col("findings")
    base = F.filter(every, lambda f: f["kind"] != "learned")
    counts = [F.size(of_kind(every, k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(every).alias("spans"),
    )
