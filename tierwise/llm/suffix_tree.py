"""Language-model scores from a probabilistic suffix tree.

A context is a run of up to :data:`DEPTH` words; it becomes a state of the tree
if the training texts have it at least :data:`MIN_COUNT` times and its
next-word distribution diverges from its longest retained suffix by more than
the description length of its entries (see :data:`COST`).  A state's
distribution is smoothed towards its parent: words seen after it get ``(c +
SMOOTHING * q) / (n + SMOOTHING)``, q the parent's probability, and the rest of
the mass follows the parent.  The root is the add-one unigram model.  Each token
is scored in the longest state that ends before it.

Contexts are kept by absolute count, so what the model gathers grows with the
input.  Two tiers hold them:

* The head: contexts of words with at least :data:`P_MIN` of all training
  tokens, that are as frequent themselves.  There are at most 1 / P_MIN a
  depth at any size; they are counted with pre-aggregation and broadcast, so no
  hot word or phrase becomes one group.
* The tail, all other contexts.  A token goes, with its context, to the group of
  its shortest context outside the head, which has fewer than P_MIN of all
  training tokens.  All longer contexts of the token end in that one, so the
  whole branch is counted, tested and scored in one place.  Tokens travel in
  packed blocks, and the sums of a block's documents come back in one row a
  part.  Groups are hashed into parts of about
  :data:`PART_TOKENS` tokens, whose number grows with the input.  A task holds
  one part, and so at least its largest group: beyond 1e11 tokens P_MIN has to
  be lowered for groups to stay within a part's memory.

Words with fewer than :data:`COMMON` of all tokens are predicted as one class,
shared out by the unigram model; as contexts all words count.  All
distributions sum to one over all words and one unknown word.  Counts of
rarer words are joined by a shuffle; none of them can be a hot key.  Words are
told apart by 64-bit hashes, in the tail by 44 bits within a part for a group's own
words, and by 32 bits for the words before those.

Texts are read in several passes, in which rows are known by a hash of
``doc_id`` and text; equal rows get equal scores.

Defined cases: null, blank and empty texts are one end token; a null
``doc_id`` is in the training part; with no training texts N = 0, V = 0 and
every token is unknown; repeated rows count and are scored one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm import common

P_MIN = 1e-4
GAMMA = 2e-3
COMMON = 1e-6
DEPTH = 3
SMOOTHING = 20.0
MIN_COUNT = 2
#: An entry of a state costs so many times half the logarithm of its count.
COST = 1.0
PART_TOKENS = 1_000_000
BLOCK_TOKENS = 1_000_000
HELD_MODULUS, HELD_REMAINDER = 7, 2

OTHER, END = 0, 1  # symbols; words have 2, 3, ...
_BITS = np.uint64(16)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_MODULUS == HELD_REMAINDER, F.lit(False))


# ------------------------------------------------------------------- counts

def _sum_by(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(c[order], first) if len(k) else c


def _count_words(batches):
    for batch in batches:
        keys, counts = [], []
        for _, _, hashes, _ in common.hash_words(batch.column("text")):
            k, c = np.unique(hashes, return_counts=True)
            keys.append(k)
            counts.append(c)
        k, c = _sum_by(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["h", "c"])


def _lookup(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table, -1 where they are not."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _streams(shared):
    """Texts -> symbol streams."""
    def run(batches):
        words, symbol = shared.value
        for batch in batches:
            streams = [np.uint16(END).tobytes()] * batch.num_rows
            for first, last, hashes, bounds in common.hash_words(batch.column("text")):
                at = _lookup(words, hashes)
                sym = np.where(at >= 0, symbol[at], OTHER).astype(np.uint16) if len(words) else np.zeros(len(hashes), np.uint16)
                for d in range(last - first):
                    streams[first + d] = np.append(sym[bounds[d]:bounds[d + 1]], np.uint16(END)).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(streams, pa.binary())], names=["stream"])
    return run


def _joined(column) -> tuple[np.ndarray, np.ndarray]:
    """All streams of a batch in a row, and the place of each symbol in its own."""
    parts = [np.frombuffer(s.as_py(), np.uint16) for s in column]
    lengths = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint16)
    return flat, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _contexts(flat: np.ndarray, place: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the ``depth`` symbols before each place (16 bits each, the
    nearest lowest), and where a text has as many before."""
    key = np.zeros(len(flat), np.uint64)
    for k in range(1, depth + 1):
        key[k:] |= flat[:-k].astype(np.uint64) << np.uint64(16 * (k - 1))
    return key, place >= depth


def _count_contexts(depth: int, shared):
    def run(batches):
        wanted = shared.value
        for batch in batches:
            flat, place = _joined(batch.column("stream"))
            key, has = _contexts(flat, place, depth)
            has &= key != OTHER if wanted is None else _lookup(wanted, key) >= 0
            both = np.stack([key[has], flat[has].astype(np.uint64)])
            order = np.lexsort(both)
            both = both[:, order]
            first = np.flatnonzero(np.append(True, (both[:, 1:] != both[:, :-1]).any(axis=0))) if len(order) else order
            c = np.diff(np.append(first, len(order)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[0][first].view(np.int64)), pa.array(both[1][first].astype(np.int32)), pa.array(c.astype(np.int64))],
                names=["ctx", "sym", "c"])
    return run


# -------------------------------------------------------------------- model

class Tree:
    """States and their entries; state 0 is the root."""

    def __init__(self, root: np.ndarray):
        self.root = root  # natural logarithms by symbol
        self.keys = [np.empty(0, np.uint64) for _ in range(DEPTH + 1)]  # by depth, sorted
        self.ids = [np.empty(0, np.int64) for _ in range(DEPTH + 1)]
        self.parent, self.backoff = np.zeros(1, np.int64), np.zeros(1)
        self.entries, self.logs = np.empty(0, np.uint64), np.empty(0)

    def state(self, flat_keys: list[np.ndarray], valid: list[np.ndarray], n: int) -> np.ndarray:
        """The longest state for each of n places."""
        out = np.zeros(n, np.int64)
        for depth in range(1, len(flat_keys)):
            if len(self.keys[depth]):
                at = _lookup(self.keys[depth], flat_keys[depth])
                out = np.where((at >= 0) & valid[depth], self.ids[depth][at], out)
        return out

    def log_prob(self, state: np.ndarray, sym: np.ndarray) -> np.ndarray:
        out, state = np.zeros(len(sym)), state.copy()
        open_ = np.arange(len(sym))
        while len(open_):
            here = state[open_]
            at_root = here == 0
            out[open_[at_root]] += self.root[sym[open_[at_root]]]
            open_, here = open_[~at_root], here[~at_root]
            at = _lookup(self.entries, (here.astype(np.uint64) << _BITS) | sym[open_].astype(np.uint64))
            hit = at >= 0
            out[open_[hit]] += self.logs[at[hit]]
            open_, here = open_[~hit], here[~hit]
            out[open_] += self.backoff[here]
            state[open_] = self.parent[here]
        return out

    def grow(self, depth: int, ctx: np.ndarray, n: np.ndarray, entry_ctx: np.ndarray, sym: np.ndarray, c: np.ndarray) -> None:
        """Add the contexts of a depth that diverge.  ``ctx`` sorted; entries
        sorted by context (their place in ``ctx``) and symbol."""
        if not len(ctx) or not len(sym):
            return
        every = np.ones(len(ctx), bool)
        tails = [ctx] + [ctx & np.uint64((1 << (16 * k)) - 1) for k in range(1, depth)]
        parent = self.state(tails, [every] * len(tails), len(ctx))
        q = np.exp(self.log_prob(parent[entry_ctx], sym))
        p = (c + SMOOTHING * q) / (n[entry_ctx] + SMOOTHING)

        def total(x):
            return np.bincount(entry_ctx, x, len(ctx))

        left_p = np.maximum(1 - total(p), 1e-12)
        left_q = np.maximum(1 - total(q), 1e-12)
        gain = total(p * np.log(p / q)) + left_p * np.log(left_p / left_q)
        keep = (n * gain >= COST * total(np.ones(len(c))) / 2 * np.log(np.maximum(n, 2))) & (total(np.ones(len(c))) > 0)
        ids = np.cumsum(keep) - 1 + len(self.parent)
        self.keys[depth], self.ids[depth] = ctx[keep], ids[keep]
        self.parent = np.append(self.parent, parent[keep])
        self.backoff = np.append(self.backoff, np.log(left_p / left_q)[keep])
        of = keep[entry_ctx]
        self.entries = np.append(self.entries, (ids[entry_ctx[of]].astype(np.uint64) << _BITS) | sym[of].astype(np.uint64))
        self.logs = np.append(self.logs, np.log(p[of]))


def _fit(streams: DataFrame, root: np.ndarray, least: float) -> tuple[Tree, list[np.ndarray]]:
    """The head of the tree, and all of its contexts by depth, retained or not."""
    spark, tree, wanted, head = streams.sparkSession, Tree(root), None, []
    for depth in range(1, DEPTH + 1):
        counted = common.stored(
            streams.mapInArrow(_count_contexts(depth, spark.sparkContext.broadcast(wanted)), "ctx long, sym int, c long")
            .groupBy("ctx", "sym").agg(F.sum("c").alias("c")), f"contexts-{depth}")
        frequent = counted.groupBy("ctx").agg(F.sum("c").alias("n")).where(F.col("n") >= least)
        rows = (counted.join(frequent, "ctx").where((F.col("c") >= GAMMA * F.col("n")) | (F.col("c") >= least))
                .select("ctx", "n", "sym", "c").toArrow())
        common.drop_stored(counted)
        col = {k: rows.column(k).to_numpy() for k in ("ctx", "n", "sym", "c")}
        key = col["ctx"].astype(np.int64).view(np.uint64)
        order = np.lexsort((col["sym"], key))
        key, n, sym, c = key[order], col["n"][order], col["sym"][order].astype(np.int64), col["c"][order]
        ctx, first, of = np.unique(key, return_index=True, return_inverse=True)
        head.append(ctx if depth == 1 else wanted)
        tree.grow(depth, ctx, n[first].astype(float), of.astype(np.int64), sym, c.astype(float))
        # The next depth: contexts one symbol longer that are frequent too.
        longer = (c >= least) & (sym > END)
        wanted = np.sort((key[longer] << _BITS) | sym[longer].astype(np.uint64))
    return tree, head


# ------------------------------------------------------------------ scoring

class Lexicon:
    """What all tasks know: the common words and the head of the tree.  A token
    has a class: 0 for words that are not common, 1 for the end, 2, 3, ... for
    the common words by falling count (small numbers pack well)."""

    def __init__(self, words, counts, symbol, total, size, docs, root):
        by_count = np.argsort(-counts, kind="stable")
        self.words, self.kinds = words, np.empty(len(words), np.int64)
        self.kinds[by_count] = np.arange(len(words)) + 2
        self.symbol = np.concatenate([[OTHER, END], symbol[by_count]]).astype(np.int64)
        self.log_base = np.log((np.concatenate([[0, docs], counts[by_count]]) + 1.0) / (total + size + 1.0))
        rare = max(1 - np.exp(self.log_base[1:]).sum(), 1 / (total + size + 1.0))
        self.log_rare, self.docs = np.log(rare), docs
        # Within OTHER a word has its share of the unigram model.
        share = np.append(self.log_rare, self.log_base[1:]) - root[OTHER]
        self.share = np.where(self.symbol == OTHER, share, 0.0)

    def kind(self, hashes: np.ndarray) -> np.ndarray:
        at = _lookup(self.words, hashes)
        return np.where(at >= 0, self.kinds[at], 0) if len(self.words) else np.zeros(len(hashes), np.int64)

    def log_prob(self, tree: Tree, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        return tree.log_prob(state, self.symbol[kind]) + self.share[kind]


def _behind(values: np.ndarray, k: int) -> np.ndarray:
    """The value ``k`` places before each place (0 before the first)."""
    out = np.zeros(len(values), values.dtype)
    out[k:] = values[:-k] if k else values
    return out


def _tokens(text, lexicon: Lexicon, tree: Tree, head: list[np.ndarray]):
    """For runs of rows: the first row, and of each token the row, the word's
    hash, the class, the state in the head, the length of the longest context
    in the head, and the length of its whole context."""
    for first, last, hashes, bounds in common.hash_words(text):
        n = np.diff(bounds) + 1
        ends = np.cumsum(n) - 1
        word = np.zeros(int(n.sum()), np.uint64)
        is_word = np.ones(len(word), bool)
        is_word[ends] = False
        word[is_word] = hashes[bounds[0]:bounds[-1]]
        kind = np.full(len(word), END, np.int64)
        kind[is_word] = lexicon.kind(word[is_word])
        sym = lexicon.symbol[kind].astype(np.uint16)
        row = np.repeat(np.arange(first, last), n)
        length = np.minimum(np.arange(len(word)) - np.repeat(ends - n + 1, n), DEPTH)
        state, inside, open_ = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), np.arange(len(word))
        for depth in range(1, DEPTH + 1):
            # Only what has its shorter context in the head is looked up.
            open_ = open_[length[open_] >= depth]
            key = _contexts(sym, length, depth)[0][open_]
            known = _lookup(head[depth - 1], key) >= 0
            open_, key = open_[known], key[known]
            inside[open_] += 1
            at = _lookup(tree.keys[depth], key)
            state[open_[at >= 0]] = tree.ids[depth][at[at >= 0]]
        yield row, word, kind, state, inside, length


def _rows(shared):
    """Per document: counts, the unigram score of its common words, the score
    of the tokens whose whole context is in the head, how many tokens are in
    the tail, and the hashes of words that are not common."""
    def run(batches):
        lexicon, tree, head = shared.value
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((6, n))
            rare = [b""] * n
            for row, word, kind, state, inside, length in _tokens(batch.column("text"), lexicon, tree, head):
                here = inside >= length
                lp = lexicon.log_prob(tree, state[here], kind[here])
                for at, (of, x) in enumerate(((row, None), (row[(kind > END) | ((kind == END) & (lexicon.docs > 0))], None),
                                              (row[kind != 0], lexicon.log_base[kind[kind != 0]]), (row[here], lp),
                                              (row[~here], None), (row[here & (kind == 0)], None))):
                    sums[at] += np.bincount(of, x, n)
                of, unknown = row[kind == 0], word[kind == 0]
                cuts = np.flatnonzero(np.diff(of)) + 1
                for r, part in zip(of[np.append(0, cuts)] if len(of) else [], np.split(unknown, cuts)):
                    rare[r] = part.tobytes()
            base, local = sums[2] / np.log(10), (sums[3] - sums[5] * lexicon.log_rare) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), batch.column("held_out"), pa.array(rare, pa.binary()),
                 pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(base), pa.array(local),
                 pa.array(sums[4].astype(np.int64))],
                names=["key", "doc_id", "held_out", "rare", "n_tokens", "known", "base", "local", "tail"])
    return run


_ROW = ("key long, doc_id long, held_out boolean, rare binary, n_tokens long, known long, base double, local double, "
        "tail long")


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, their bytes of equal weight together, each
    such plane with its length: compressed by itself, as it is if that doesn't
    help, or nothing if all are zero."""
    out = []
    for a in arrays:
        for plane in a.view(np.uint8).reshape(len(a), a.itemsize).T:
            raw = plane.tobytes() if plane.any() else b""
            small = pa.compress(raw, codec="zstd", asbytes=True) if raw else raw
            best = min(raw, small, key=len)
            out += [len(best).to_bytes(4, "little"), best]
    return b"".join(out)


def _unpack(data: bytes, *kinds: tuple[type, int]) -> list[np.ndarray]:
    at, out = 0, []
    for kind, n in kinds:
        planes = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
        for k in range(planes.shape[1]):
            size = int.from_bytes(data[at:at + 4], "little")
            raw = data[at + 4:at + 4 + size]
            if size:
                planes[:, k] = np.frombuffer(raw if size == n else pa.decompress(raw, n, codec="zstd", asbytes=True), np.uint8)
            at += 4 + size
        out.append(planes.view(kind).reshape(n))
    return out


def _steps(places: np.ndarray) -> np.ndarray:
    """Rising places as steps, which pack better; cumsum gives them back."""
    return np.diff(places, prepend=0).astype(np.uint32)


def _block(keys: np.ndarray, number: int) -> int:
    """A name for the tokens packed together, so that their sums meet again."""
    mixed = common.mix(keys.view(np.uint64) + np.arange(len(keys), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return int(common.mix(mixed.sum(dtype=np.uint64, keepdims=True) + np.uint64(number)).view(np.int64)[0])


def _tail(shared, parts: int):
    """Tokens of the tail, sorted by group and packed by part.  Parts are equal
    ranges of the groups' hashes, of which 44 bits within a part are kept."""
    spare = np.uint64(max(0, 20 - parts.bit_length()))

    def blocks(block, keys, train, group, state, second, third, kind, row):
        order = np.argsort(group)
        group, state, second, third, kind, row = (x[order] for x in (group, state, second, third, kind, row))
        part = np.minimum((group.astype(np.float64) * (parts / 2.0 ** 64)).astype(np.int64), parts - 1)
        cuts = np.searchsorted(part, np.arange(parts + 1))
        # The keys and numbers of tokens go once, through any part, to where the block's sums meet.
        out = [(block % parts, block, len(keys), 0, 0, _pack(keys, np.bincount(row, minlength=len(keys)).astype(np.uint32)))]
        for p in np.flatnonzero(np.diff(cuts)):
            o = slice(cuts[p], cuts[p + 1])
            used = np.zeros(len(keys), bool)
            used[row[o]] = True
            at = (np.cumsum(used) - 1)[row[o]]
            first = _runs(group[o])
            times = np.diff(np.append(first, len(at)))
            steps = np.diff(group[o][first] >> spare, prepend=np.uint64(0))
            out.append((int(p), block, int(used.sum()), len(first), len(at), _pack(
                _steps(np.flatnonzero(used)), train[used], steps, times.astype(np.uint32), state[o][first].astype(np.int32),
                second[o], third[o], kind[o].astype(np.int32), at.astype(np.uint32))))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
            names=["part", "block", "n_rows", "n_groups", "n", "data"])

    def run(batches):
        lexicon, tree, head = shared.value
        for batch in batches:
            keys = batch.column("key").to_numpy()
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            pieces, held, number = [], 0, 0
            for row, word, kind, state, inside, length in _tokens(batch.column("text"), lexicon, tree, head):
                t = np.flatnonzero(inside < length)
                if not len(t):
                    continue
                # A context word is its class, or 32 bits of its hash.
                name = np.where(kind > END, kind.astype(np.uint64), (word >> np.uint64(32)) | np.uint64(1 << 31)).astype(np.uint32)
                depth = inside[t]
                group = np.zeros(len(t), np.uint64)
                for k in range(DEPTH):
                    group = np.where(k <= depth, common.mix(group * np.uint64(0x9E3779B97F4A7C15) + _behind(word, k + 1)[t]), group)
                group = (group >> spare) << spare
                # Up to two more words before the group's own; 0 for none.
                more = [np.where(depth + j < length[t], name[np.maximum(t - depth - j - 1, 0)], 0).astype(np.uint32) for j in (1, 2)]
                row, kind, state = row[t].astype(np.int32), kind[t].astype(np.int32), state[t].astype(np.int32)
                for lo in range(0, len(t), BLOCK_TOKENS):
                    cut = slice(lo, lo + BLOCK_TOKENS)
                    pieces.append((group[cut], state[cut], more[0][cut], more[1][cut], kind[cut], row[cut]))
                    held += len(pieces[-1][0])
                    if held >= BLOCK_TOKENS:
                        yield blocks(_block(keys, number), keys, train, *map(np.concatenate, zip(*pieces)))
                        pieces, held, number = [], 0, number + 1
            if held:
                yield blocks(_block(keys, number), keys, train, *map(np.concatenate, zip(*pieces)))
    return run


def _runs(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1]))


def refine(lp: np.ndarray, group: np.ndarray, kind: np.ndarray, train: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Log-probabilities after one more context word: ``group`` numbers the
    longer contexts, ``lp`` are the probabilities in their suffixes.  Contexts
    that don't diverge, and tokens that aren't ``valid``, keep theirs."""
    key = (group.astype(np.uint64) << np.uint64(21)) | kind.astype(np.uint64)
    order = np.argsort(key)
    first = _runs(key[order])
    c = np.add.reduceat(train[order], first, dtype=np.float64)
    of, log_q = group[order][first], lp[order][first]
    q, m = np.exp(log_q), int(group.max()) + 1
    n = np.bincount(of, c, m)
    p, seen = (c + SMOOTHING * q) / (n[of] + SMOOTHING), c > 0

    def total(x):
        return np.bincount(of[seen], x[seen], m)

    left_p, left_q = np.maximum(1 - total(p), 1e-12), np.maximum(1 - total(q), 1e-12)
    gain = total(p * (np.log(p) - log_q)) + left_p * np.log(left_p / left_q)
    keep = (n >= MIN_COUNT) & (n * gain >= COST * total(np.ones(len(c))) / 2 * np.log(np.maximum(n, 2)))
    new = np.where(keep[of], np.where(seen, np.log(p), log_q + np.log(left_p / left_q)[of]), log_q)
    out = np.empty(len(lp))
    out[order] = np.repeat(new, np.diff(np.append(first, len(key))))
    return np.where(valid, out, lp)


def _score_part(shared):
    """Count, test and score all contexts of one part; one row a block, with
    the sums of its documents."""
    def run(table: pa.Table) -> pa.Table:
        lexicon, tree, _ = shared.value
        places, columns, base = [], [], [0]
        out = [(b, n_rows, True, data) for b, n_rows, n, data in zip(*(
            table.column(c).to_pylist() for c in ("block", "n_rows", "n", "data"))) if not n]
        table = table.filter(pa.compute.greater(table.column("n"), 0))
        if not len(table):
            return _sums(out)
        for n_rows, n_groups, n, data in zip(*(table.column(c).to_pylist() for c in ("n_rows", "n_groups", "n", "data"))):
            own, train, steps, times, state, second, third, kind, at = _unpack(
                data, (np.uint32, n_rows), (np.bool_, n_rows), (np.uint64, n_groups), (np.uint32, n_groups),
                (np.int32, n_groups), (np.uint32, n), (np.uint32, n), (np.int32, n), (np.uint32, n))
            columns.append((np.repeat(np.cumsum(steps, dtype=np.uint64), times), np.repeat(state, times), second, third, kind, train[at], at.astype(np.int64) + base[-1]))
            places.append(own)  # as steps, which go on as they came
            base.append(base[-1] + n_rows)
        group, state, second, third, kind, train, row = map(np.concatenate, zip(*columns))
        del columns
        lp = lexicon.log_prob(tree, state.astype(np.int64), kind.astype(np.int64))
        del state
        context = np.unique(group, return_inverse=True)[1]
        lp = refine(lp, context, kind, train, np.ones(len(lp), bool))
        for word in (second, third):
            context = np.unique((context.astype(np.uint64) << np.uint64(32)) | word, return_inverse=True)[1]
            lp = refine(lp, context, kind, train, word != 0)
        lp -= np.where(kind == 0, lexicon.log_rare, 0.0)
        # A part's sum of one document travels in single precision (relative error 6e-8).
        sums = (np.bincount(row, lp, base[-1]) / np.log(10)).astype(np.float32)
        blocks = table.column("block").to_pylist()
        return _sums(out + [(b, len(own), False, _pack(own, sums[lo:hi]))
                            for b, own, lo, hi in zip(blocks, places, base, base[1:])])
    return run


def _sums(rows) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["block", "n_rows", "is_keys", "data"])


def _sum_block(table: pa.Table) -> pa.Table:
    """The sums of one block's documents over all parts.  Blocks of equal name
    hold the same documents in the same order."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("n_rows", "is_keys", "data"))))
    named = [_unpack(data, (np.int64, n), (np.uint32, n)) for n, is_keys, data in rows if is_keys]
    # Blocks of equal name add up: as many tokens as sums.
    keys, count = named[0][0], sum(times.astype(np.int64) for _, times in named)
    s = np.zeros(len(keys))
    for n, is_keys, data in rows:
        if not is_keys:
            steps, sums = _unpack(data, (np.uint32, n), (np.float32, n))
            s[np.cumsum(steps, dtype=np.int64)] += sums
    return pa.table({"key": keys[count > 0], "s": s[count > 0], "n": count[count > 0]})


def _rare_words(batches):
    for batch in batches:
        rows, words, times = [], [], []
        for row, rare in zip(batch.column("row"), batch.column("rare")):
            w, c = np.unique(np.frombuffer(rare.as_py(), np.uint64), return_counts=True)
            rows.append(np.full(len(w), row.as_py()))
            words.append(w)
            times.append(c)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(rows).astype(np.int64)), pa.array(np.concatenate(words).view(np.int64)),
                 pa.array(np.concatenate(times).astype(np.int64))], names=["row", "h", "times"])


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10) of every document."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    texts = docs.select(F.xxhash64(F.col("doc_id").cast("string"), text).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                        held_out(F.col("doc_id")).alias("held_out"), text.alias("text"))
    train = texts.where("not held_out").select("text")
    counts = common.stored(train.mapInArrow(_count_words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    size, total = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    n_train = train.count()
    size, total = size + (n_train > 0), total + n_train

    rows = counts.where(F.col("c") >= COMMON * total).toArrow()
    words = rows.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(words)
    words, common_counts = words[order], rows.column("c").to_numpy()[order].astype(float)
    least = max(P_MIN * total, MIN_COUNT)
    is_symbol = common_counts >= least
    symbol = np.where(is_symbol, np.cumsum(is_symbol) + 1, OTHER)

    root = np.empty(int(is_symbol.sum()) + 2)
    root[2:] = (common_counts[is_symbol] + 1) / (total + size + 1)
    root[END] = (n_train + 1) / (total + size + 1)
    root[OTHER] = max(1 - root[1:].sum(), 1 / (total + size + 1))
    root = np.log(root)
    streams = common.stored(train.mapInArrow(_streams(spark.sparkContext.broadcast((words, symbol))), "stream binary"), "streams")
    tree, head = _fit(streams, root, least)
    common.drop_stored(streams)

    shared = spark.sparkContext.broadcast((Lexicon(words, common_counts, symbol, total, size, n_train, root), tree, head))
    scored = common.stored(texts.mapInArrow(_rows(shared), _ROW).withColumn("row", F.monotonically_increasing_id()), "rows")
    parts = 1 + scored.agg(F.coalesce(F.sum("tail"), F.lit(0))).first()[0] // PART_TOKENS
    tokens = texts.select("key", "held_out", "text").mapInArrow(
        _tail(shared, parts), "part int, block long, n_rows int, n_groups int, n int, data binary")
    sums = common.spread(tokens, "part").groupBy("part").applyInArrow(_score_part(shared), "block long, n_rows int, is_keys boolean, data binary")
    tail = (sums.groupBy("block").applyInArrow(_sum_block, "key long, s double, n long")
            .groupBy("key").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    rare = scored.select("row", "rare").where(F.octet_length("rare") > 0).mapInArrow(_rare_words, "row long, h long, times long")
    seen = counts.where(F.col("c") < COMMON * total)
    one = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(total + size + 1)))
    more = (rare.join(seen, "h", "left").groupBy("row")
            .agg(F.sum(one * F.col("times")).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("more_known")))
    zero = F.lit(0)
    # Equal rows share a key: each of them gets its part of the sum.
    of_tail = F.coalesce(F.col("s") * F.col("tail") / F.col("n"), zero)
    return scored.join(more, "row", "left").join(tail, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", zero)).alias("base_score"),
        (F.col("local") + of_tail + F.coalesce("more", zero)).alias("score"))
