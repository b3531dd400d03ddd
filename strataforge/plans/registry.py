"""Stages and their order."""

from __future__ import annotations

from collections.abc import Mapping

#: stage -> stages that it needs, in the order in which ties are run.
STAGES: dict[str, tuple[str, ...]] = {
    "discover_sources": (),
    "ingest": ("discover_sources",),
    "chapter_splitter": ("ingest",),
    "chunk_builder": ("chapter_splitter",),
    "evidence_index": ("chunk_builder",),
    "embedding_builder": ("evidence_index",),
    "wiki_builder": ("evidence_index",),
    "analysis_builder": ("wiki_builder",),
}


def order(stages: Mapping[str, tuple[str, ...]]) -> list[str]:
    """Every stage after those that it needs, otherwise as listed; ValueError for unknown needs and cycles."""
    unknown = {n for needs in stages.values() for n in needs} - set(stages)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    out: list[str] = []
    while len(out) < len(stages):
        ready = [s for s, needs in stages.items() if s not in out and all(n in out for n in needs)]
        if not ready:
            raise ValueError(f"stages need each other: {sorted(set(stages) - set(out))}")
        out.append(ready[0])
    return out


def affected(stages: Mapping[str, tuple[str, ...]], changed: set[str]) -> set[str]:
    """The changed stages and all that depend on them, along the graph's edges."""
    out: set[str] = set()
    for stage in order(stages):
        if stage in changed or any(n in out for n in stages[stage]):
            out.add(stage)
    return out
