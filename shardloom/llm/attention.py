"""A small causal self-attention language model over subword ids, in numpy.

One attention layer over windows of two blocks: the tokens of a block attend to
the block before and, causally, to their own, so consecutive windows overlap by
a block and each token is scored once.  Positions act through a learned bias by
distance.  The output is a choice among groups of ids and one within the group;
ids too rare for the model share one output and split it by their counts.

Attention and outputs are normalised powers: e**x is taken as (1 + x / 16)**16,
never below a small positive number.  Four squarings take a tenth of the time of
numpy's exponential, and whatever positive function is normalised, the shares sum
to one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

BLOCK, WIDTH, HIDDEN, GROUPS, MEMBERS = 16, 16, 32, 32, 32
RARE = 0
#: The power that stands for the exponential, and the least base it is taken of.
POWER, LEAST = 16, 0.05
#: Windows, and rows of outputs, whose gradients are taken at a time.
CACHED, CACHED_ROWS = 96, 1_024


def _visible() -> np.ndarray:
    """distance of key j of a window from query i of its second block; negative: in the future."""
    return BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None, :]


@cache
def _floor(least: float, kind: np.dtype) -> np.ndarray:
    return np.full(1 << 14, least, kind)


def _at_least(u: np.ndarray, least: float) -> np.ndarray:
    """max(u, least) in place; numpy compares two arrays in a fourth of the time that an array and a number take."""
    flat, floor = u.reshape(-1), _floor(least, u.dtype)
    for lo in range(0, len(flat), len(floor)):
        part = flat[lo : lo + len(floor)]
        np.maximum(part, floor[: len(part)], out=part)
    return u


def _powered(u: np.ndarray) -> np.ndarray:
    """max(u, LEAST) ** POWER in place."""
    _at_least(u, LEAST)
    for _ in range(POWER.bit_length() - 1):
        np.square(u, out=u)
    return u


def _squared(u: np.ndarray) -> np.ndarray:
    """u ** POWER."""
    p = np.square(u)
    for _ in range(POWER.bit_length() - 2):
        np.square(p, out=p)
    return p


@dataclass
class Model:
    """Weights, the model id of each subword id, and log10 P(id | rare)."""

    weights: dict[str, np.ndarray]
    known: np.ndarray
    rare: np.ndarray

    def tables(self) -> dict[str, np.ndarray]:
        """What a token needs, as one row of each model id: without absolute positions it depends on the id alone.  Logits x come out as 1 + x / POWER."""
        w, scale = self.weights, np.float32(1 / POWER)
        near = _visible()
        q, k = w["E"] @ w["Q"] * (scale / np.float32(np.sqrt(WIDTH))), w["E"] @ w["K"]
        rows = np.concatenate([q, k, w["E"] @ w["V"]], axis=1)
        of = lambda x, b: np.concatenate([x * scale, (1 + b * scale)[..., None, :]], axis=-2)
        near = {"near": 1 + w["near"][np.clip(near, 0, 2 * BLOCK - 1)] * scale, "seen": (near >= 0).astype(np.float32)}
        return {"rows": rows, "own": w["E"], **near, "group": of(w["G"], w["g"]), "member": of(w["M"], w["m"])}


def vocabulary(sample: list[np.ndarray], n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """by_counts() of a sample."""
    return by_counts(np.bincount(np.concatenate(sample), minlength=n_ids) if sample else np.zeros(n_ids, np.int64))


def by_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Model ids by frequency (0: rare), and log10 P(id | rare)."""
    n_ids = len(counts)
    order = np.lexsort((np.arange(n_ids), -counts))[: GROUPS * MEMBERS - 1]
    known = np.zeros(n_ids, np.int32)
    known[order] = np.arange(1, len(order) + 1)
    rest = np.where(known == RARE, counts + 1.0, 0.0)
    return known, np.log10(np.maximum(rest, 1e-300) / max(rest.sum(), 1.0)).astype(np.float64)


def blocks_of(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts laid out in blocks: places into ids (-1: padding) as (blocks, BLOCK), whether a block has one before it in its text, and its text."""
    n = -(-lengths // BLOCK)
    text = np.repeat(np.arange(len(lengths)), n)
    first = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
    within = np.arange(int(n.sum())) - np.repeat(first, n)
    place = within[:, None] * BLOCK + np.arange(BLOCK)
    place = np.where(place < lengths[text][:, None], place + starts[text][:, None], -1)
    return place, within > 0, text


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    d, ids = WIDTH, GROUPS * MEMBERS
    return {
        "E": normal(ids, d, scale=0.5), "Q": normal(d, d, scale=0.25), "K": normal(d, d, scale=0.25), "V": normal(d, d, scale=0.25), "near": np.zeros(2 * BLOCK, np.float32),
        "W1": normal(d, HIDDEN, scale=0.3), "b1": np.zeros(HIDDEN, np.float32), "W2": normal(HIDDEN, d, scale=0.2),
        "G": normal(d, GROUPS, scale=0.1), "g": np.zeros(GROUPS, np.float32), "M": normal(GROUPS, d, MEMBERS, scale=0.1), "m": np.zeros((GROUPS, MEMBERS), np.float32),
    }


def _logits(shares: np.ndarray) -> np.ndarray:
    """Logits that give these shares of each row; the greatest one is 0."""
    return (POWER * ((shares / shares.max(axis=-1, keepdims=True)) ** (1 / POWER) - 1)).astype(np.float32)


def gradients(w: dict[str, np.ndarray], before: np.ndarray, own: np.ndarray, led: np.ndarray, target: np.ndarray, counted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss in nats and its gradient over a batch of windows.

    Attention takes CACHED windows at a time and the outputs CACHED_ROWS, so that
    what one pass makes is still in a processor's cache for the next.
    """
    b, d = len(own), WIDTH
    near, root, kind = _visible(), np.sqrt(d).astype(w["E"].dtype), w["E"].dtype
    seen, bias, ones = (near >= 0).astype(kind), (1 + w["near"][np.clip(near, 0, None)] / POWER).astype(kind), np.ones(max(b * BLOCK, 2 * BLOCK), kind)
    by_id = np.concatenate([w["E"] @ w["Q"] / (root * POWER), w["E"] @ w["K"], w["E"] @ w["V"]], axis=1)
    of_query, of_key = np.ascontiguousarray(by_id[:, :d]), np.ascontiguousarray(by_id[:, d:])
    keys = np.concatenate([before, own], axis=1)
    h, held = w["E"].take(own.ravel(), axis=0), []
    for lo in range(0, b, CACHED):
        hi = min(lo + CACHED, b)
        q, kv = of_query.take(own[lo:hi], axis=0), of_key.take(keys[lo:hi], axis=0)
        u = np.matmul(q, kv[..., :d].transpose(0, 2, 1))
        u += bias
        p = _squared(_at_least(u, LEAST))
        p *= seen
        p[np.flatnonzero(~led[lo:hi]), :, :BLOCK] = 0
        p /= (p.reshape(-1, 2 * BLOCK) @ ones[: 2 * BLOCK]).reshape(-1, BLOCK, 1)
        h[lo * BLOCK : hi * BLOCK] += np.matmul(p, kv[..., d:]).reshape(-1, d)
        held.append((lo, hi, q, kv, u, p))
    r = h @ w["W1"]
    r += w["b1"]
    _at_least(r, 0.0)
    z = r @ w["W2"]
    z += h
    loss, dz, grad = _output_gradients(w, z, target.ravel(), counted.ravel())
    dr = dz @ w["W2"].T
    dr *= r > 0
    grad["W2"], grad["W1"], grad["b1"] = r.T @ dz, h.T @ dr, ones[: b * BLOCK] @ dr
    dh = dr @ w["W1"].T
    dh += dz
    # By column and token, so that _summed() reads runs; of queries and keys up to a constant.
    dq, dkv, by_near = np.empty((b, d, BLOCK), kind), np.empty((b, 2 * d, 2 * BLOCK), kind), 0.0
    for lo, hi, q, kv, u, p in held:
        of = dh[lo * BLOCK : hi * BLOCK].reshape(-1, BLOCK, d)
        ds = np.matmul(of, kv[..., d:].transpose(0, 2, 1))
        np.matmul(of.transpose(0, 2, 1), p, out=dkv[lo:hi, d:])
        ds -= ((ds * p).reshape(-1, 2 * BLOCK) @ ones[: 2 * BLOCK]).reshape(-1, BLOCK, 1)
        ds *= p
        ds /= u
        by_near = by_near + ones[: hi - lo] @ ds.reshape(hi - lo, -1)
        np.matmul(kv[..., :d].transpose(0, 2, 1), ds.transpose(0, 2, 1), out=dq[lo:hi])
        np.matmul(q.transpose(0, 2, 1), ds, out=dkv[lo:hi, :d])
    grad["near"] = np.bincount(np.clip(near, 0, None).ravel(), weights=np.where(near.ravel() >= 0, by_near, 0), minlength=2 * BLOCK).astype(kind)
    # What a token adds depends on its id alone, so sums by id come before the products.
    of_queries = _summed(own.ravel(), dq, len(w["E"])) / root
    of_keys = _summed(keys.ravel(), dkv, len(w["E"]))
    of_keys[:, :d] *= POWER  # q was divided by it, and by the root
    grad["Q"], grad["K"], grad["V"] = w["E"].T @ of_queries, w["E"].T @ of_keys[:, :d], w["E"].T @ of_keys[:, d:]
    grad["E"] = _summed(own.ravel(), dh.T[None], len(w["E"])) + of_queries @ w["Q"].T + of_keys[:, :d] @ w["K"].T + of_keys[:, d:] @ w["V"].T
    return loss, grad


def _summed(ids: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """(n, columns): the sums over the tokens of each id below n; ``columns`` is given as (parts, columns, tokens of a part)."""
    ids = ids.astype(np.intp)
    return np.stack([np.bincount(ids, weights=columns[:, c].ravel(), minlength=n) for c in range(columns.shape[1])], axis=1).astype(columns.dtype)


def _output_gradients(w: dict[str, np.ndarray], z: np.ndarray, target: np.ndarray, use: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
    """Mean loss of the counted targets, its gradient by z, and by G, g, M and m; a target's group and its place there are drawn in one go."""
    kind, d = z.dtype, WIDTH
    n = max(1, int(use.sum()))
    order = np.argsort((target // MEMBERS).astype(np.int16), kind="stable")
    order = order[use[order]]
    ordered = target[order]
    cuts = np.concatenate([[0], np.cumsum(np.bincount(ordered // MEMBERS, minlength=GROUPS))])
    held = z.take(order, axis=0)
    back, found = np.empty((len(order), d), kind), np.empty(len(order), kind)
    outputs = np.concatenate([np.broadcast_to(w["G"], (GROUPS, d, GROUPS)), w["M"]], axis=2) / kind.type(POWER)
    biases = 1 + np.concatenate([np.broadcast_to(w["g"], (GROUPS, GROUPS)), w["m"]], axis=1) / kind.type(POWER)
    returned = np.ascontiguousarray((outputs * kind.type(POWER / n)).transpose(0, 2, 1))
    total, totals = np.zeros_like(outputs), np.zeros_like(biases)
    sums, ones = np.ones(MEMBERS, kind), np.ones(CACHED_ROWS, kind)
    places = GROUPS + ordered % MEMBERS + np.arange(len(order)) * (GROUPS + MEMBERS)
    for i in np.flatnonzero(np.diff(cuts)):
        for lo in range(cuts[i], cuts[i + 1], CACHED_ROWS):
            hi = min(lo + CACHED_ROWS, cuts[i + 1])
            u = held[lo:hi] @ outputs[i]
            u += biases[i]
            p = _squared(_at_least(u, LEAST))
            shares, flat, theirs = p.reshape(-1, MEMBERS), p.reshape(-1), places[lo:hi] - lo * (GROUPS + MEMBERS)
            shares /= (shares @ sums)[:, None]
            own = flat.take(theirs)
            np.multiply(p[:, i], own, out=found[lo:hi])
            p[:, i] -= 1
            flat[theirs] = own - 1
            p /= u
            np.matmul(p, returned[i], out=back[lo:hi])
            total[i] += held[lo:hi].T @ p
            totals[i] += ones[: hi - lo] @ p
    total /= n
    totals /= n
    dz = np.empty_like(z) if len(order) == len(z) else np.zeros_like(z)
    dz[order] = back
    return -float(np.log(found).sum()) / n, dz, {"G": total[:, :, :GROUPS].sum(0), "g": totals[:, :GROUPS].sum(0), "M": total[:, :, GROUPS:], "m": totals[:, GROUPS:]}


def descended(w: dict[str, np.ndarray], texts: list[np.ndarray], rng: np.random.Generator, steps: int, batch: int, rate: float, once: bool = False) -> None:
    """Adam on w, in place, over the windows of texts of model ids; the first id of each is its context only.  With ``once`` each window is taken once, else they are drawn."""
    ids = np.concatenate(texts)
    lengths = np.asarray([len(x) - 1 for x in texts])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    place, led, _ = blocks_of(ids, starts, lengths)
    names = sorted(w)
    ends = np.cumsum([w[k].size for k in names]).tolist()
    first, second = np.zeros(ends[-1], np.float32), np.zeros(ends[-1], np.float32)
    order = rng.permutation(len(place)) if once else None
    for step in range(1, steps + 1):
        pick = order[(step - 1) * batch : step * batch] if once else rng.integers(0, len(place), batch)
        at = place[pick]
        counted = at >= 0
        at = np.maximum(at, 0)
        _, grad = gradients(w, np.where(led[pick][:, None], ids[np.maximum(place[pick - 1], 0)], 0), ids[at], led[pick], ids[at + 1], counted)
        now = rate * min(1.0, step / 50) * (1 - 0.95 * step / steps)
        g = np.concatenate([grad[k].ravel() for k in names], dtype=np.float32)
        first += 0.1 * (g - first)
        np.square(g, out=g)
        g -= second
        g *= 0.01
        second += g
        np.multiply(second, 1 / (1 - 0.99**step), out=g)
        np.sqrt(g, out=g)
        g += 1e-8
        np.divide(first, g, out=g)
        g *= now / (1 - 0.9**step)
        for k, end in zip(names, ends):
            w[k] -= g[end - w[k].size : end].reshape(w[k].shape)


def trained(sample: list[np.ndarray], n_ids: int, end: int, steps: int = 700, batch: int = 128, rate: float = 0.05, seed: int = 0, counts: np.ndarray | None = None) -> Model:
    """Fit the model with Adam to texts given as subword ids.

    Each text ends with and is led by ``end``.  With ``counts``, how often each
    subword id occurs in all texts, the sample is pieces of texts that are taken
    as they are and the ids the model knows are those of all texts.
    """
    rng = np.random.default_rng(seed)
    ends = np.asarray([end])
    known, rare = vocabulary([*sample, np.repeat(ends, max(1, len(sample)))], n_ids) if counts is None else by_counts(counts)
    w = initial(rng)
    texts = [known[np.concatenate([ends, x, ends])] for x in sample] if counts is None else [known[x] for x in sample]
    if not texts:
        return Model(w, known, rare)
    seen = np.bincount(np.concatenate(texts), minlength=GROUPS * MEMBERS) if counts is None else np.bincount(known, weights=counts, minlength=GROUPS * MEMBERS)
    seen = seen.reshape(GROUPS, MEMBERS) + 0.1
    w["g"], w["m"] = _logits(seen.sum(1)), _logits(seen)
    descended(w, texts, rng, steps, batch, rate)
    return Model(w, known, rare)


def refined(w: dict[str, np.ndarray], texts: list[np.ndarray], batch: int = 512, rate: float = 0.008) -> tuple[dict[str, np.ndarray], int]:
    """Copy of w after one pass over texts given as model ids, and the number of blocks they have."""
    w = {k: v.copy() for k, v in w.items()}
    blocks = sum(-(-(len(x) - 1) // BLOCK) for x in texts)
    descended(w, texts, np.random.default_rng(blocks), -(-blocks // batch), batch, rate, once=True)
    return w, blocks


def scores(model: Model, tables: dict[str, np.ndarray], ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, blocks: int = 96) -> np.ndarray:
    """log10 probability of each text; ids holds model ids, each text led by the end id and closed by it (its last target), ``lengths`` counts targets."""
    of_token = token_scores(model, tables, ids, starts, lengths, blocks)
    text = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(text, weights=of_token[np.repeat(starts + 1 - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))], minlength=len(lengths))


def token_scores(model: Model, tables: dict[str, np.ndarray], ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, blocks: int = 96, rounds: int = 24) -> np.ndarray:
    """log10 probability of each id after those before it in its text, at the id's own place; 0 where a text is led by the end id.

    Attention takes so many blocks at a time, the outputs so many times as many.
    Arguments are those of scores().
    """
    place, led, _ = blocks_of(ids, starts, lengths)
    found = np.zeros(len(ids), np.float32)
    for top in range(0, len(place), blocks * rounds):
        last = min(top + blocks * rounds, len(place))
        at = place[top:last].ravel()
        use = at >= 0
        hidden = np.empty((len(at), WIDTH + 1), np.float32)
        hidden[:, WIDTH] = 1  # for the biases
        for lo in range(top, last, blocks):
            hi = min(lo + blocks, last)
            hidden[(lo - top) * BLOCK : (hi - top) * BLOCK, :WIDTH] = _attended(model.weights, tables, ids, place, led, lo, hi)
        to = at[use] + 1
        found[to] = _outputs(tables, hidden if len(to) == len(at) else hidden[use], ids[to])
    if not np.isfinite(found).all():
        raise FloatingPointError("a weight of the model is out of range")
    found /= np.float32(np.log(10))
    return found


_ONES = np.ones(max(GROUPS, MEMBERS, 2 * BLOCK), np.float32)


def _attended(w: dict[str, np.ndarray], tables: dict[str, np.ndarray], ids: np.ndarray, place: np.ndarray, led: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """What the outputs of blocks lo to hi are made from."""
    d = WIDTH
    # These blocks and the one before them; what stands before the first one isn't seen.
    around = ids[np.maximum(np.concatenate([place[max(lo - 1, 0) : max(lo, 1)], place[lo:hi]]), 0)]
    rows = tables["rows"].take(around, axis=0)
    window = np.lib.stride_tricks.as_strided(rows, (hi - lo, 2 * BLOCK, rows.shape[2]), rows.strides)
    s = np.matmul(rows[1:, :, :d], window[:, :, d : 2 * d].transpose(0, 2, 1))
    s += tables["near"]
    _powered(s)
    s *= tables["seen"]
    s[np.flatnonzero(~led[lo:hi]), :, :BLOCK] = 0
    total = s.reshape(-1, 2 * BLOCK) @ _ONES[: 2 * BLOCK]
    s /= np.maximum(total, np.float32(1e-30)).reshape(-1, BLOCK, 1)
    h = np.matmul(s, window[:, :, 2 * d :]).reshape(-1, d)
    h += tables["own"].take(around[1:].ravel(), axis=0)
    r = h @ w["W1"]
    r += w["b1"]
    _at_least(r, 0.0)
    h += r @ w["W2"]
    return h


def _outputs(tables: dict[str, np.ndarray], h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logarithm of each target's probability."""
    group, member = target // MEMBERS, target % MEMBERS
    order = np.argsort(group.astype(np.int16), kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=GROUPS))])
    z, m, out = h.take(order, axis=0), member[order], np.empty(len(h), np.float32)
    for i in np.flatnonzero(np.diff(cuts)):
        for lo in range(cuts[i], cuts[i + 1], 2_048):
            rows = slice(lo, min(lo + 2_048, cuts[i + 1]))
            u, v = _powered(z[rows] @ tables["group"]), _powered(z[rows] @ tables["member"][i])
            own = v.ravel()[np.arange(0, v.size, MEMBERS) + m[rows]]
            out[rows] = np.log(u[:, i] / (u @ _ONES[:GROUPS])) + np.log(own / (v @ _ONES[:MEMBERS]))
    found = np.empty_like(out)
    found[order] = out
    return found
