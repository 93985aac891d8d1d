"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, intensifier, threat, intent, target, negation, reported speech or other. Small transducers
rewrite the symbols of a clause in turn: one marks what a negation governs, one what stands in reported speech, one what
is aimed at a target before it, one insults after an intensifier and one threats after a word of intent. Their composition
is one machine, run over each clause that holds an insult or a threat; a last one, run from the end, marks what is aimed
at a target behind it. A clause matches with the strongest of the paths that it puts out, such as an insult aimed at
somebody or a negated threat. A text's score weighs its matched clauses by their paths.

Intensifiers, threats, intents, targets, negations and verbs of reporting are short fixed lists. Insults are stems learned
from labelled rows: the starts of words (and short whole words) that distinct toxic texts hold far oftener than clean ones,
by the ratio of their shares and by a test of likelihoods, with neither a share of texts that they must reach nor a limit to their number.
Words that are negated or reported are left out of both counts, so a word that clean texts only quote is learned. The
weights of the paths are a logistic fit on the same rows, drawn towards fixed prior weights.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from converge.llm import common
from converge.llm.common import U64
from converge.llm.langid import _words

#: Bound on the labelled rows that stems and weights are learned from, drawn by a hash of the id.
TRAIN_ROWS = 40_000
#: Stem lengths in bytes.
SHORTEST, LONGEST = 3, 8
#: A stem's share among toxic texts over that among clean ones, smoothed by half a text, at least; and the likelihood ratio
#: (twice its logarithm) of a stem that tells toxic texts from clean ones over one that does not, at least: a chance below 1e-6.
LIFT, RATIO = 40.0, 25.0
#: Words after a negation that it governs, and after an intensifier or a word of intent that these bear on.
GOVERNED = 3

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, STRONG, INTENT = "other", "insult", "threat", "target", "negation", "report", "strong", "intent"
SYMBOLS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, STRONG, INTENT)
# Word lists in English, French, German and Spanish.
LISTS = {
    THREAT: (
        "kill kills killed killing murder murders murdered murdering hurt hurts hurting destroy destroys destroyed destroying strangle strangles strangled strangling shoot shoots shot shooting stab stabs stabbed stabbing "
        "tuer tue tues tué tuée tués tuera tuerai frapper frappe frappé frappée frapperai détruire détruit détruirai étrangler étrangle étranglé étranglerai assassiner assassine assassiné assassinerai "
        "töten töte tötet getötet umbringen umbringe umgebracht umzubringen ermorden ermorde ermordet zerstören zerstöre zerstört erschießen erschieße erschossen erwürgen erwürge erwürgt "
        "matar mato mata matado mataré matando golpear golpeo golpeado golpearé destruir destruyo destruido destruiré disparar disparo disparado dispararé asesinar asesino asesinado asesinaré"
    ),
    TARGET: "you your yourself yours tu toi te ton ta vous votre du dich dir dein deine euch ihr usted ustedes ti tuyo vosotros",
    NEGATION: "cannot not no never neither nor without pas jamais ni sans aucun nicht kein keine keinen nie niemals ohne nunca jamás tampoco sin",
    STRONG: "such so total complete utter fucking damn bloody quel quelle sacré tellement totaler völlig verdammt verdammter so menudo maldito pedazo",
    INTENT: "will would gonna shall going must should ll vais va allons veux werde werden wirst soll voy vas vamos quiero debe",
    REPORT: "said says wrote writes claimed reported quoted dit écrit affirme rapporté sagte schrieb behauptet zitiert dijo escribió afirma citado",
}
#: Kinds of paths, with the weights that a fit starts from.
PATHS = {"insult aimed": 3.0, "insult strong": 2.5, "insult": 2.0, "threat aimed": 2.0, "threat meant": 1.5, "threat": 0.5, "insult negated": 0.5, "insult reported": 0.5, "threat negated": 0.0, "threat reported": 0.0}
BIAS = -3.0
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[10, 33, 46, 59, 63]] = True


class Transducer:
    """A deterministic machine that rewrites symbols: (state, symbol) to (state, symbol), started in state 0."""

    def __init__(self, step: dict[tuple[int, str], tuple[int, str]]) -> None:
        self.step = step

    def then(self, other: Transducer) -> Transducer:
        """The composition, which gives other what this machine puts out."""
        numbers, todo, step = {(0, 0): 0}, [(0, 0)], {}
        symbols = {s for _, s in self.step}
        while todo:
            a, b = pair = todo.pop()
            for s in symbols:
                a2, middle = self.step[a, s]
                b2, out = other.step[b, middle]
                if (a2, b2) not in numbers:
                    numbers[a2, b2] = len(numbers)
                    todo.append((a2, b2))
                step[numbers[pair], s] = (numbers[a2, b2], out)
        return Transducer(step)

    def run(self, symbols: list[str]) -> list[str]:
        state, out = 0, []
        for s in symbols:
            state, put = self.step[state, s]
            out.append(put)
        return out


def _marking(states: int, trigger: str, mark: str, kinds: tuple[str, ...] = (INSULT, THREAT)) -> Transducer:
    """Marks insults and threats that have no mark while a trigger's influence lasts: for states - 1 symbols, or for good if
    there are 2."""
    step = {}
    marked = [f"{k} {m}" for k in (INSULT, THREAT) for m in ("negated", "reported", "aimed", "strong", "meant")]
    for state in range(states):
        for s in [*SYMBOLS, *marked]:
            after = states - 1 if s == trigger else state if states == 2 else max(0, state - 1)
            step[state, s] = (after, f"{s} {mark}" if state > 0 and s in kinds else s)
    return Transducer(step)


def grammar() -> Transducer:
    """Negation first, so that what it governs is neither reported nor aimed; then reported speech, the target, insult, threat."""
    machine = _marking(GOVERNED + 1, NEGATION, "negated")
    for part in (_marking(2, REPORT, "reported"), _marking(2, TARGET, "aimed"), _marking(GOVERNED + 1, STRONG, "strong", (INSULT,)), _marking(GOVERNED + 1, INTENT, "meant", (THREAT,))):
        machine = machine.then(part)
    return machine


def backwards() -> Transducer:
    """Run from the end of a clause: what the others left unmarked is aimed at a target behind it."""
    return _marking(2, TARGET, "aimed")


def _prefix_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
    """A row for each word: its starts of SHORTEST to LONGEST bytes as numbers, and the whole word if shorter than LONGEST; that
    of a longer one is the word's hash if hashes are given, else 0."""
    keys = np.zeros((len(starts), LONGEST - SHORTEST + 2), dtype=U64)
    key = np.zeros(len(starts), dtype=U64)
    for n in range(1, LONGEST + 1):
        long_enough = lengths >= n
        at = np.minimum(starts + n - 1, max(len(data) - 1, 0))
        key = np.where(long_enough, key | (data[at].astype(U64) << U64(8 * (n - 1))), key)
        if n >= SHORTEST:
            keys[:, n - SHORTEST] = np.where(long_enough, key, U64(0))
    whole = lengths < LONGEST
    keys[:, -1] = np.where(whole, key | (U64(1) << (U64(8) * np.minimum(lengths, LONGEST - 1).astype(U64))), U64(0) if hashes is None else hashes)
    return keys


def key_of(word: str, whole: bool) -> int:
    """The key of a whole word, or of all words that start so (up to LONGEST bytes)."""
    b = word.encode()
    if whole and len(b) >= LONGEST:
        return int(common.word_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0])
    b = b[:LONGEST]
    return int.from_bytes(b + (b"\x01" if whole and len(b) < LONGEST else b""), "little")


def _shadowed(fixed: Grammar, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True for words that stand within GOVERNED words after a negation, or anywhere after a verb of reporting, in their clause."""
    symbols, n = fixed.symbols_of(data, starts, lengths), np.arange(len(starts))
    clause = _clauses(data, starts, doc)
    begin = np.maximum.accumulate(np.where(np.append(True, clause[1:] != clause[:-1]), n, 0)) if len(n) else n
    last = lambda symbol: np.maximum.accumulate(np.where(symbols == SYMBOLS.index(symbol), n, -1)) if len(n) else n
    negated, reported = last(NEGATION), last(REPORT)
    return ((negated >= begin) & (n > negated) & (n - negated <= GOVERNED)) | ((reported >= begin) & (n > reported))


def _clauses(data: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A number for each word that is the same within a clause of a document only."""
    broken = np.cumsum(_BREAK[data]) if len(data) else np.zeros(1, np.int64)
    return broken[starts] + doc * (broken[-1] + 1) if len(starts) else np.zeros(0, np.int64)


def _doc_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, key) pairs of the words that are neither negated nor reported."""
    data, starts, lengths, doc, _ = _words(data, off)
    plain = ~_shadowed(Grammar([]), data, starts, lengths, doc)
    keys = _prefix_keys(data, starts[plain], lengths[plain])
    flat, docs = keys.reshape(-1), np.repeat(doc[plain], keys.shape[1])
    order = np.lexsort((flat, docs))
    flat, docs = flat[order], docs[order]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = (flat[1:] != flat[:-1]) | (docs[1:] != docs[:-1])
    new &= flat != 0
    return docs[new], flat[new]


def _key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts each key stands."""
    for piece, data, off in common.pieces(batches, "_text"):
        toxic = piece.column("_toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        docs, keys = _doc_keys(data, off)
        found, back = np.unique(keys, return_inverse=True)
        n = np.bincount(back, minlength=len(found))
        bad = np.bincount(back, toxic[docs], len(found)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(bad), pa.array(n - bad)], names=["key", "toxic", "clean"])


def _telling(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """The keys that stand in toxic texts often enough against clean ones, and surely so."""
    a, b = F.col("toxic"), F.col("clean")
    lift = (a + 0.5) / (n_toxic + 1) / ((b + 0.5) / (n_clean + 1))
    part = lambda k, n: F.when(k > 0, k * F.log(k / ((a + b) * (n / (n_toxic + n_clean))))).otherwise(0.0)
    return counts.where((a > 0) & (lift >= LIFT) & (2 * (part(a, n_toxic) + part(b, n_clean)) >= RATIO))


def _stems(toxic: dict[int, int]) -> list[int]:
    """The shortest of the telling keys, each grown for as long as nearly all toxic texts with it have the longer one."""
    by_bytes = {k.to_bytes(8, "little").rstrip(b"\0"): k for k in toxic}
    children: dict[bytes, list[bytes]] = {}
    for b in by_bytes:
        children.setdefault(b[:-1], []).append(b)
    kept: set[bytes] = set()
    for b in sorted(by_bytes, key=lambda b: (len(b), b)):
        if not any(b[:n] in kept for n in range(1, len(b))):
            kept.add(b)
    grown = set()
    for b in kept:
        while more := [c for c in children.get(b, []) if toxic[by_bytes[c]] >= 0.97 * toxic[by_bytes[b]]]:
            b = max(more, key=lambda c: (toxic[by_bytes[c]], c))
        grown.add(by_bytes[b])
    return sorted(grown)


#: Paths from the strongest down, as they are listed.
_RANK = {path: k for k, path in enumerate(PATHS)}


@functools.cache
def _machines() -> tuple[Transducer, Transducer]:
    return grammar(), backwards()


class Grammar:
    """The composed machine with a lexicon of stems and the weights of paths."""

    def __init__(self, stems: list[int], weights: np.ndarray | None = None) -> None:
        lexicon = {}
        for symbol, words in LISTS.items():
            for w in words.split():
                lexicon[key_of(w, whole=True)] = SYMBOLS.index(symbol)
        for k in stems:
            lexicon[k] = SYMBOLS.index(INSULT)
        self.keys = np.array(sorted(lexicon), dtype=U64)
        self.symbols = np.array([lexicon[int(k)] for k in self.keys], dtype=np.int8)
        self.machine, self.backwards = _machines()
        self.weights = np.array([BIAS, *PATHS.values()]) if weights is None else weights

    def symbols_of(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A symbol for each word; an insult before any other, a longer start before a shorter."""
        out = np.zeros(len(starts), dtype=np.int8)
        if not len(starts):
            return out
        h = common.word_hashes(data, starts, starts + lengths)
        _, first, back = np.unique(h, return_index=True, return_inverse=True)
        keys = _prefix_keys(data, starts[first], lengths[first], h[first])
        found = np.zeros(len(first), dtype=np.int8)
        for k in range(keys.shape[1]):
            at = np.minimum(np.searchsorted(self.keys, keys[:, k]), len(self.keys) - 1)
            hit = self.keys[at] == keys[:, k]
            insult = SYMBOLS.index(INSULT)
            found = np.where(hit & (found != insult), self.symbols[at], found)
        return found[back]

    def matches(self, raw: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, str, int]]:
        """Matched clauses as document, start of the first and end of the last insult or threat (bytes), strongest path, and
        how many insults and threats they hold."""
        data, starts, lengths, doc, _ = _words(raw, off)
        symbols = self.symbols_of(data, starts, lengths)
        clause = _clauses(data, starts, doc)
        strong = np.flatnonzero((symbols == SYMBOLS.index(INSULT)) | (symbols == SYMBOLS.index(THREAT)))
        found, done = [], -1
        for i in strong.tolist():
            if i <= done:
                continue
            a = b = i
            while a > 0 and clause[a - 1] == clause[i]:
                a -= 1
            while b + 1 < len(symbols) and clause[b + 1] == clause[i]:
                b += 1
            done = b
            paths = self.paths([SYMBOLS[s] for s in symbols[a : b + 1].tolist()])
            at = [k for k, path in enumerate(paths, a) if path in PATHS]
            d = int(doc[i])
            found.append((d, int(starts[at[0]] - off[d]), int(starts[at[-1]] + lengths[at[-1]] - off[d]), min((paths[k - a] for k in at), key=_RANK.__getitem__), len(at)))
        return found

    def paths(self, symbols: list[str]) -> list[str]:
        """What the machines put out for the symbols of one clause."""
        return self.backwards.run(self.machine.run(symbols)[::-1])[::-1]

    def features(self, matched: list[tuple[int, int, int, str, int]], n: int) -> np.ndarray:
        """For each path the logarithm of one more than what its clauses hold."""
        counts = np.zeros((n, 1 + len(PATHS)))
        names = list(PATHS)
        for d, _, _, path, held in matched:
            counts[d, 1 + names.index(path)] += held
        counts = np.log1p(counts)
        counts[:, 0] = 1
        return counts

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -500, 500)))


def _features(machine: Grammar):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, data, off in common.pieces(batches, "_text"):
            x = machine.features(machine.matches(data, off), piece.num_rows)
            yield pa.RecordBatch.from_arrays([piece.column("_toxic"), pa.array(list(x[:, 1:]), pa.list_(pa.float64()))], names=["_toxic", "x"])

    return measure


def _fit_weights(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton steps, drawn to the prior weights."""
    prior = np.array([BIAS, *PATHS.values()])
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Grammar:
    """Learn from at most about `rows` labelled rows; null labels are left out, null texts are empty, equal texts count once.

    Without a toxic or a clean row the grammar has only its fixed lists and prior weights.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_toxic"))
    share = min(1.0, rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("_id", F.lit(6)), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    # About `rows` ids at most, so the texts stay where they are but for the sample.
    train = common.checkpoint(texts.join(F.broadcast(known), "_id").select("_toxic", "_text", F.xxhash64("_text").alias("_h")).dropDuplicates(["_h", "_toxic"]).select("_toxic", "_text"))
    n_of = {r["_toxic"]: r["n"] for r in train.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n_of.get(1, 0), n_of.get(0, 0)
    if not n_toxic or not n_clean:
        return Grammar([])
    counts = train.mapInArrow(_key_counts, "key long, toxic long, clean long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # What is telling in a sample of bounded size is bounded too: a handful of keys for each toxic text at most.
    machine = Grammar(_stems({r["key"] & 0xFFFFFFFFFFFFFFFF: r["toxic"] for r in _telling(counts, n_toxic, n_clean).collect()}))
    measured = train.mapInArrow(_features(machine), "_toxic int, x array<double>").toPandas()
    x = np.column_stack([np.ones(len(measured)), np.array(measured["x"].tolist())])
    machine.weights = _fit_weights(x, measured["_toxic"].to_numpy(dtype=float))
    return machine


def _scorer(machine: Grammar):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, data, off in common.pieces(batches, "_text"):
            matched = machine.matches(data, off)
            scores = machine.scores(machine.features(matched, piece.num_rows))
            spans: list[list[dict]] = [[] for _ in range(piece.num_rows)]
            for d, a, b, path, _ in matched:
                spans[d].append({"start": a, "end": b, "path": path})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("path", pa.string())]))
            yield pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(spans, kind)], names=["_id", "score", "predicted", "matches"])

    return score


def score(docs: DataFrame, machine: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 if score >= 0.5), matches (start, end in bytes, path).

    A null or empty text has no matches and the score of any text without one. Rows are scored on their own, so repeated
    rows and ids give repeated results. An empty table gives an empty result; other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return source.mapInArrow(_scorer(machine), "_id long, score double, predicted int, matches array<struct<start:long,end:long,path:string>>").withColumnRenamed("_id", id_col)


def _keeper(machine: Grammar, text_col: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, data, off in common.pieces(batches, text_col):
            scores = machine.scores(machine.features(machine.matches(data, off), piece.num_rows))
            yield piece.filter(pa.array(scores < 0.5))

    return keep


def keep_clean(docs: DataFrame, machine: Grammar, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is below 0.5, with all their columns, whatever their names.

    Rows are judged on their own: null and empty texts have no matches, repeated rows go the same way, and an empty table
    gives an empty result.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    numbered = docs.toDF(*names)
    return numbered.mapInArrow(_keeper(machine, names[docs.columns.index(text_col)]), numbered.schema).toDF(*docs.columns)
