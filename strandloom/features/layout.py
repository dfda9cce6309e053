"""How a vector's columns are divided: segments by share of the width, parts by share of their segment, remainders last."""

from __future__ import annotations

from dataclasses import dataclass

#: Fixed values: (segment, share of the width, ((part, share of the segment), ...)); a last share is what remains.
NODE_SEGMENTS = (
    ("ontology", 0.25, (("class_identity", 0.625), ("class_hierarchy", 0.1875), ("ontology_source", 0.1875))),
    ("properties", 0.375, (("property_presence", 0.50), ("domain_range", 0.29), ("property_hierarchy", 0.21))),
    ("literals", 0.375, (("numeric", 0.67), ("categorical", 0.33))),
)
EDGE_SEGMENTS = (
    ("temporal", 0.375, (("time_delta", 0.40), ("period_flags", 0.35), ("direction", 0.25))),
    ("contrast", 0.375, (("difference", 0.40), ("ratio", 0.35), ("magnitude", 0.25))),
    ("context", 0.25, (("namespace", 0.40), ("label_similarity", 0.35), ("relation_identity", 0.25))),
)


@dataclass(frozen=True)
class Part:
    start: int
    dim: int


def _shares(total: int, shares: list[float]) -> list[int]:
    """Whole widths by rounded share, each at least 1; the last has the rest, taken from the one before it if nothing is left."""
    out = [max(1, round(total * s)) for s in shares[:-1]]
    rest = total - sum(out)
    if rest < 1:
        out[-1] += rest - 1
        rest = 1
    return [*out, rest]


class Layout:
    """parts: name -> Part. They tile 0..width without gap or overlap."""

    def __init__(self, width: int, segments: tuple, least: int, fixed: dict[str, int] | None = None):
        if width < least:
            raise ValueError(f"a width of {width} is less than {least}, so some part would be empty")
        self.width, self.parts = width, {}
        start = 0
        for (_name, _share, parts), total in zip(segments, _shares(width, [s for _, s, _ in segments]), strict=True):
            dims = _shares(total, [s for _, s in parts])
            first = parts[0][0]
            if first in (fixed or {}):
                own = fixed[first]
                if not 1 <= own <= total - len(parts) + 1:
                    raise ValueError(f"{first} can be 1 to {total - len(parts) + 1} wide, not {own}")
                rest = total - own
                middle = [max(1, round(total * s)) for _, s in parts[1:-1]]
                last = rest - sum(middle)
                if last < 1:
                    middle[-1], last = rest - 1, 1
                dims = [own, *middle, last]
            for (part, _), dim in zip(parts, dims, strict=True):
                self.parts[part] = Part(start, dim)
                start += dim
        if start != width or any(p.dim < 1 for p in self.parts.values()):
            raise ValueError(f"a width of {width} can't be divided")

    def __getitem__(self, name: str) -> Part:
        return self.parts[name]

    def owner(self, dim: int) -> str:
        """The part a column belongs to."""
        return next(n for n, p in self.parts.items() if p.start <= dim < p.start + p.dim)


def node_layout(width: int = 1024, class_identity: int | None = None) -> Layout:
    return Layout(width, NODE_SEGMENTS, 32, {"class_identity": class_identity} if class_identity else None)


def edge_layout(width: int = 32) -> Layout:
    return Layout(width, EDGE_SEGMENTS, 9)
