"""Operator 9: language by a bidirectional gated recurrent network over bytes.

The network reads the pieces between white space one by one, from both ends, starting afresh at each: every byte gets
a probability per language, and a document's probability is the mean over all its bytes. Equal pieces have equal
labels, so a task runs each different piece once and weighs it by its use. Trained here, in numpy, by backpropagation
through time on a bounded sample of labelled pieces.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

UNKNOWN = "und"
# bounds of the sample the network is fitted on: languages (the most frequent), documents and pieces of each
MOST_LANGS, DOCS_EACH, PIECES_EACH = 64, 200, 6000
HIDDEN, STEPS, BATCH, RATE = 12, 900, 256, 0.01
# a longer piece is read in parts of this many bytes
LONGEST = 32
CACHED_PIECES = 600_000
# documents whose best language has a lower mean probability are in none of the known ones; held-out rows of four
# languages, short and mixed ones too, lie at 0.29 and above
LEAST_SCORE = 0.25


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _forward(table, bias, u, codes):
    """Hidden states after each step; ``codes``: (words, steps). Keeps what the way back needs."""
    n, steps = codes.shape
    h = np.zeros((n, u.shape[0]), np.float32)
    kept = []
    k = u.shape[0]
    for t in range(steps):
        x, own = table[codes[:, t]] + bias, h @ u
        gates = _sigmoid(x[:, : 2 * k] + own[:, : 2 * k])
        z, r = gates[:, :k], gates[:, k:]
        new = np.tanh(x[:, 2 * k :] + r * own[:, 2 * k :])
        kept.append((h, z, r, new, own[:, 2 * k :]))
        h = new + z * (h - new)
    return [k[0] for k in kept[1:]] + [h], kept


def _backward(u, kept, outer):
    """Gradients of the gates' inputs at each step and of ``u``; ``outer``: gradients of the hidden states."""
    du, dh, inputs = np.zeros_like(u), 0, []
    for (h, z, r, new, own), d in zip(reversed(kept), reversed(outer)):
        dh = dh + d
        dn = dh * (1 - z) * (1 - new * new)
        dz = dh * (h - new) * z * (1 - z)
        dr = dn * own * r * (1 - r)
        through = np.concatenate([dz, dr, dn * r], axis=1)
        du += h.T @ through
        inputs.append(np.concatenate([dz, dr, dn], axis=1))
        dh = dh * z + through @ u.T
    return inputs[::-1], du


class ByteGRU:
    """Two gated recurrent networks, one from each end, and a softmax over languages at every byte."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        small = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
        self.p = {}
        for side in "fb":
            self.p |= {f"w{side}": small(256, 3 * hidden), f"c{side}": np.zeros(3 * hidden, np.float32), f"u{side}": small(hidden, 3 * hidden)}
        self.p |= {"v": small(2 * hidden, len(langs)), "d": np.zeros(len(langs), np.float32)}

    def _run(self, codes):
        p = self.p
        ahead, kept_f = _forward(p["wf"], p["cf"], p["uf"], codes)
        back, kept_b = _forward(p["wb"], p["cb"], p["ub"], codes[:, ::-1])
        states = np.stack([np.concatenate([a, b], axis=1) for a, b in zip(ahead, back[::-1])], axis=1)
        scores = states @ p["v"] + p["d"]
        scores -= scores.max(axis=2, keepdims=True)
        odds = np.exp(scores)
        return states, odds / odds.sum(axis=2, keepdims=True), kept_f, kept_b

    def step(self, codes, labels) -> dict:
        """Gradients of the mean cross-entropy over all positions of words of one length."""
        p, k = self.p, self.hidden
        states, probs, kept_f, kept_b = self._run(codes)
        n, steps, _ = probs.shape
        d = probs.copy()
        d[np.arange(n), :, labels] -= 1
        d /= n * steps
        ds = d @ p["v"].T
        g = {"v": np.einsum("nth,ntl->hl", states, d), "d": d.sum(axis=(0, 1))}
        for side, kept, outer, order in (
            ("f", kept_f, [ds[:, t, :k] for t in range(steps)], codes),
            ("b", kept_b, [ds[:, t, k:] for t in reversed(range(steps))], codes[:, ::-1]),
        ):
            inputs, g[f"u{side}"] = _backward(p[f"u{side}"], kept, outer)
            flat = np.concatenate(inputs)
            hot = np.zeros((len(flat), 256), np.float32)
            hot[np.arange(len(flat)), order.T.ravel()] = 1
            g[f"w{side}"], g[f"c{side}"] = hot.T @ flat, flat.sum(axis=0)
        return g

    def fit(self, pieces: list[bytes], labels: list[int], weights: list[float], steps: int = STEPS, seed: int = 1) -> "ByteGRU":
        """Adam over batches of pieces of one length, drawn by weight."""
        rng = np.random.default_rng(seed)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(i)
        lengths = sorted(by_length)
        weights, labels = np.asarray(weights, float), np.asarray(labels)
        groups = [np.array(by_length[n]) for n in lengths]
        codes = [np.frombuffer(b"".join(pieces[i] for i in g), np.uint8).reshape(len(g), n) for g, n in zip(groups, lengths)]
        sums = [np.cumsum(weights[g]) for g in groups]
        share = np.array([s[-1] * n for s, n in zip(sums, lengths)])
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, steps + 1):
            at = int(rng.choice(len(lengths), p=share / share.sum()))
            pick = np.minimum(np.searchsorted(sums[at], rng.random(BATCH) * sums[at][-1]), len(groups[at]) - 1)
            grads = self.step(codes[at][pick], labels[groups[at][pick]])
            rate = RATE * min(1.0, 2 * (1 - (t - 1) / steps))
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.001 * (g * g - s[k])
                self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        return self

    def sums(self, pieces: list[bytes]) -> np.ndarray:
        """Per piece, the probabilities of its bytes summed over the positions."""
        out = np.zeros((len(pieces), len(self.langs)), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(i)
        for length, rows in by_length.items():
            for at in range(0, len(rows), 8192):
                part = rows[at : at + 8192]
                codes = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8).reshape(len(part), length)
                out[part] = self._run(codes)[1].sum(axis=1)
        return out


class Labeller:
    """Document probabilities; remembers the sums of pieces that it has seen."""

    def __init__(self, net: ByteGRU):
        self.net, self.known = net, {}
        self.rows = np.zeros((0, len(net.langs)), np.float32)
        self.sizes = np.zeros(0, np.int64)

    def _learn(self, fresh: list[bytes]) -> None:
        parts, owner = [], []
        for i, piece in enumerate(fresh):
            cut = [piece[a : a + LONGEST] for a in range(0, len(piece), LONGEST)]
            parts += cut
            owner += [i] * len(cut)
        sums = np.zeros((len(fresh), self.rows.shape[1]))
        np.add.at(sums, owner, self.net.sums(parts))
        self.known.update(zip(fresh, range(len(self.rows), len(self.rows) + len(fresh))))
        self.rows = np.concatenate([self.rows, sums.astype(np.float32)])
        self.sizes = np.concatenate([self.sizes, [len(p) for p in fresh]])

    def probabilities(self, texts: list[str]) -> np.ndarray:
        pieces = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        if len(self.known) > CACHED_PIECES:
            self.__init__(self.net)
        known = self.known
        fresh = list(dict.fromkeys(w for ws in pieces for w in ws if w not in known))
        if fresh:
            self._learn(fresh)
        out = np.zeros((len(texts), self.rows.shape[1]))
        for i, ws in enumerate(pieces):
            at = np.fromiter((known[w] for w in ws), np.int64, len(ws))
            for a in range(0, len(at), 1 << 16):
                out[i] += self.rows[at[a : a + (1 << 16)]].sum(axis=0, dtype=float)
            out[i] /= max(1, self.sizes[at].sum())
        return out


def held_out() -> F.Column:
    """crc32 of the doc_id as text leaves 2 when divided by 4; false for a null doc_id, which is not learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame) -> DataFrame:
    """``lang, piece, n``: at most PIECES_EACH pieces of DOCS_EACH documents of each of MOST_LANGS languages.

    Chosen by hash among the rows to learn from; whole texts, never only their beginnings.
    """
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    light = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    langs = light.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).select("lang")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = light.join(langs, "lang", "left_semi").withColumn("k", first).filter(F.col("k") <= DOCS_EACH).select("doc_id", "lang")
    # at most MOST_LANGS x DOCS_EACH rows
    texts = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen.distinct()), ["doc_id", "lang"])
    pieces = texts.select("lang", F.explode(F.split("text", "[\\x20\\x09-\\x0D]+")).alias("piece")).filter("piece <> ''")
    counts = pieces.groupBy("lang", "piece").agg(F.count("*").alias("n"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece"))
    return counts.withColumn("k", order).filter(F.col("k") <= PIECES_EACH).select("lang", "piece", "n")


def learn(docs: DataFrame, steps: int = STEPS) -> ByteGRU | None:
    """The fitted network; None if there is nothing to learn from. Languages weigh alike."""
    found = sorted(tuple(r) for r in sample(docs).collect())
    if not found:
        return None
    langs = sorted({lang for lang, _, _ in found})
    total = dict.fromkeys(langs, 0)
    parts = []
    for lang, piece, n in found:
        data = piece.encode("utf-8", "surrogatepass")
        parts += [(lang, data[a : a + LONGEST], n) for a in range(0, len(data), LONGEST)]
        total[lang] += n
    at = {lang: i for i, lang in enumerate(langs)}
    return ByteGRU(langs).fit([p for _, p, _ in parts], [at[g] for g, _, _ in parts], [n / total[g] for g, _, n in parts], steps)


def _label(net: ByteGRU | None, carried: str):
    def run(batches):
        labeller = Labeller(net) if net else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            named, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if labeller:
                for a in range(0, len(texts), 256):
                    read = [i for i in range(a, min(a + 256, len(texts))) if texts[i] and any(map(str.isalpha, texts[i]))]
                    if read:
                        probs = labeller.probabilities([texts[i] for i in read])
                        for i, p in zip(read, probs):
                            best = int(p.argmax())
                            named[i], scores[i] = net.langs[best], min(1.0, float(p[best]))
            kept = {carried: batch.column(carried)}
            yield pa.RecordBatch.from_pydict(kept | {"lang_pred": pa.array(named, pa.string()), "score": pa.array(scores, pa.float64())})

    return run


def identify(docs: DataFrame, net: ByteGRU | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    A text that is null or has no letter is ``und`` with score 0, as is everything if there was nothing to learn from.
    Repeated rows stay; other columns are ignored. Empty table: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_label(net, "doc_id"), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, net: ByteGRU | None, least: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``docs`` with a known language and a score of at least ``least``; all columns as they were.

    If there was nothing to learn from, no language can be refused and all rows stay.
    """
    if net is None:
        return docs
    packed = docs.select(F.struct(*docs.columns).alias("rest"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([packed.schema["rest"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    found = packed.mapInArrow(_label(net, "rest"), schema)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("rest.*")
