"""Degradation sequences planned as columns: each row's gates, parameters and repeats are drawn from hashes of its keys, and become its steps array."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import draws

STEP = "struct<type: string, params: map<string, double>>"


@dataclass
class Step:
    """A step with a fixed probability, or one drawn from a range; a fixed parameter wins over a range of the same name."""

    type: str
    probability: float = 1.0
    parameters: dict[str, float] = field(default_factory=dict)
    probability_range: tuple[float, float] | None = None
    parameter_ranges: dict[str, tuple[float, float]] = field(default_factory=dict)


@dataclass
class Sequence:
    """Steps in order, repeat times, and once more as long as draws stay under repeat_probability."""

    name: str
    probability: float
    steps: list[Step]
    repeat: int = 1
    repeat_probability: float = 0.0


def step_struct(type_: str | Column, params: dict[str, Column | float]) -> Column:
    """One element of a steps array."""
    entries = [x for k, v in params.items() for x in (F.lit(k), (v if isinstance(v, Column) else F.lit(float(v))).cast("double"))]
    made = F.create_map(*entries) if entries else F.create_map().cast("map<string, double>")
    return F.struct((F.lit(type_) if isinstance(type_, str) else type_).alias("type"), made.alias("params"))


def present(steps: list[tuple[Column | None, Column]]) -> Column:
    """The steps whose gates are open (None: always), in order."""
    return F.filter(F.array(*[s if gate is None else F.when(gate, s) for gate, s in steps]), lambda s: s.isNotNull())


def drawn_step(step: Step, seed: int, stream: str, *keys) -> tuple[Column, Column]:
    """Whether a step applies, and the step with its parameters."""
    chance = F.lit(step.probability) if step.probability_range is None else draws.between(*step.probability_range, seed, f"{stream}/chance", *keys)
    ranged = {k: draws.between(*r, seed, f"{stream}/{k}", *keys) for k, r in step.parameter_ranges.items() if k not in step.parameters}
    return draws.uniform(seed, f"{stream}/gate", *keys) < chance, step_struct(step.type, step.parameters | ranged)


def repeats(repeat: int, probability: float, seed: int, stream: str, *keys) -> Column:
    """repeat plus a geometric number: k or more extra with probability ** k."""
    if not 0 <= probability < 1:
        raise ValueError("a repeat probability must be at least 0 and less than 1")
    if probability == 0:
        return F.lit(repeat)
    u = F.greatest(draws.uniform(seed, f"{stream}/repeat", *keys), F.lit(2.0**-53))
    return (F.lit(repeat) + F.floor(F.log(u) / F.log(F.lit(probability)))).cast("int")


def drawn_sequence(sequence: Sequence, seed: int, *keys) -> Column:
    """The steps array of one sequence; every repeat draws anew."""

    def once(k):
        return present([drawn_step(s, seed, f"{sequence.name}/{i}", *keys, k) for i, s in enumerate(sequence.steps)])

    n = repeats(sequence.repeat, sequence.repeat_probability, seed, sequence.name, *keys)
    return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), once))).otherwise(F.array().cast(f"array<{STEP}>"))


def controlled(sequences: list[Sequence], seed: int, *keys) -> tuple[Column, Column]:
    """Name and steps of the sequence that a row draws by the shares of the probabilities, which may add up to 1 at most; none: nothing is applied."""
    if sum(s.probability for s in sequences) > 1 + 1e-12:
        raise ValueError("the probabilities of the sequences add up to more than 1")
    if not sequences:
        return F.lit(None).cast("string"), F.array().cast(f"array<{STEP}>")
    name = draws.choice([(s.name, s.probability) for s in sequences], draws.uniform(seed, "sequence", *keys))
    steps = None
    for s in sequences:
        made = drawn_sequence(s, seed, *keys)
        steps = F.when(name == s.name, made) if steps is None else steps.when(name == s.name, made)
    return name, steps


#: Orders of the two-order pipeline: gates, ranges and shares of a published blind super-resolution recipe.
ORDERS = (
    {"blur": 1.0, "sinc": 0.1, "sigma": (0.2, 3.0), "resize": (0.2, 0.7, 0.1), "range": (0.15, 1.5), "gauss": 0.5, "noise": (1.0, 30.0), "poisson": (0.05, 3.0), "gray": 0.4, "jpeg": (30.0, 95.0)},
    {"blur": 0.8, "sinc": 0.1, "sigma": (0.2, 1.5), "resize": (0.3, 0.4, 0.3), "range": (0.3, 1.2), "gauss": 0.5, "noise": (1.0, 25.0), "poisson": (0.05, 2.5), "gray": 0.4, "jpeg": (30.0, 95.0)},
)
KINDS = [("iso", 0.45), ("aniso", 0.25), ("generalized_iso", 0.12), ("generalized_aniso", 0.03), ("plateau_iso", 0.12), ("plateau_aniso", 0.03)]


def _blur(o: dict, sizes: list[int], seed: int, s: str, *keys) -> Column:
    """A kernel of a drawn kind, or a circular low pass."""
    kind = draws.choice(KINDS, draws.uniform(seed, f"{s}/kind", *keys))
    plateau, general = kind.startswith("plateau"), kind.startswith("generalized")
    size = F.element_at(F.array(*[F.lit(float(n)) for n in sizes]), (F.floor(draws.uniform(seed, f"{s}/size", *keys) * len(sizes)) + 1).cast("int"))
    sx = draws.between(*o["sigma"], seed, f"{s}/sx", *keys)
    sy = F.when(kind.endswith("aniso"), draws.between(*o["sigma"], seed, f"{s}/sy", *keys)).otherwise(sx)
    low = draws.gate(0.5, seed, f"{s}/side", *keys)
    beta = F.when(low, draws.between(0.5, 1.0, seed, f"{s}/beta", *keys)).otherwise(F.when(plateau, draws.between(1.0, 2.0, seed, f"{s}/beta", *keys)).otherwise(draws.between(1.0, 4.0, seed, f"{s}/beta", *keys)))
    kernel = step_struct("kernel_blur", {"size": size, "sx": sx, "sy": sy, "theta": F.when(kind.endswith("aniso"), draws.between(-3.141592653589793, 3.141592653589793, seed, f"{s}/theta", *keys)).otherwise(0.0), "beta": beta, "shape": F.when(plateau, 2.0).when(general, 1.0).otherwise(0.0)})
    return F.when(draws.gate(o["sinc"], seed, f"{s}/sinc", *keys), step_struct("sinc", {"size": size, "cutoff": draws.between(1.0471975511965976, 3.141592653589793, seed, f"{s}/cutoff", *keys)})).otherwise(kernel)


def _factor(o: dict, seed: int, s: str, *keys) -> Column:
    """Larger, smaller or kept, by shares."""
    way = draws.choice(list(zip(("up", "down", "keep"), o["resize"], strict=True)), draws.uniform(seed, f"{s}/way", *keys))
    low, high = o["range"]
    u = lambda a, b: draws.between(a, b, seed, f"{s}/factor", *keys)
    return F.when(way == "up", u(1.0, high)).when(way == "down", u(low, 1.0)).otherwise(1.0)


def _mode(seed: int, s: str, *keys) -> Column:
    return F.floor(draws.uniform(seed, f"{s}/mode", *keys) * 3)


def _noise(o: dict, seed: int, s: str, *keys) -> Column:
    gray = F.when(draws.gate(o["gray"], seed, f"{s}/gray", *keys), 1.0).otherwise(0.0)
    gauss = step_struct("gauss_noise", {"sigma": draws.between(*o["noise"], seed, f"{s}/sigma", *keys), "gray": gray})
    poisson = step_struct("poisson_noise", {"scale": draws.between(*o["poisson"], seed, f"{s}/scale", *keys), "gray": gray})
    return F.when(draws.gate(o["gauss"], seed, f"{s}/noise", *keys), gauss).otherwise(poisson)


def two_orders(h: Column, w: Column, scale: int, seed: int, *keys, sizes: tuple[int, ...] = tuple(range(7, 22, 2)), final_sinc: float = 0.8) -> Column:
    """
    Steps of the two-order pipeline: sharpen; blur, resize, noise and JPEG twice, the second time to a size counted from
    that of the result (h / scale, w / scale); then that size with a low pass, and JPEG, in either order; 8-bit values.
    """
    a, b = ORDERS
    jpeg = lambda o, s: step_struct("jpeg", {"quality": draws.between(*o["jpeg"], seed, s, *keys)})
    second = _factor(b, seed, "b/resize", *keys)
    to = lambda f, s: step_struct("resize_to", {"h": F.greatest(F.floor(h / scale * f), F.lit(1)), "w": F.greatest(F.floor(w / scale * f), F.lit(1)), "mode": _mode(seed, s, *keys)})
    ends = [to(F.lit(1.0), "end/resize")]
    low = (draws.gate(final_sinc, seed, "end/sinc", *keys), step_struct("sinc", {"size": F.lit(float(max(sizes))), "cutoff": draws.between(1.0471975511965976, 3.141592653589793, seed, "end/cutoff", *keys)}))
    first = draws.gate(0.5, seed, "end/order", *keys)
    steps = [
        (None, step_struct("unsharp", {"weight": 0.5, "size": 51.0})),
        (draws.gate(a["blur"], seed, "a/blur/gate", *keys), _blur(a, list(sizes), seed, "a/blur", *keys)),
        (None, step_struct("resize", {"factor": _factor(a, seed, "a/resize", *keys), "mode": _mode(seed, "a/resize", *keys)})),
        (None, _noise(a, seed, "a", *keys)),
        (None, jpeg(a, "a/jpeg")),
        (draws.gate(b["blur"], seed, "b/blur/gate", *keys), _blur(b, list(sizes), seed, "b/blur", *keys)),
        (None, to(second, "b/resize")),
        (None, _noise(b, seed, "b", *keys)),
        (~first, jpeg(b, "b/jpeg")),
        (None, ends[0]),
        low,
        (first, jpeg(b, "b/jpeg")),
        (None, step_struct("quantise", {})),
    ]
    return present(steps)


