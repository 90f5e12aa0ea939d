"""The stages of a run, what each needs, and what a run does about each."""

from __future__ import annotations

from dataclasses import dataclass

# Stages in order, and what each depends on.
NEEDS: dict[str, tuple[str, ...]] = {
    "panel": (),
    "input": (),
    "qc": ("input",),
    "clustering": ("qc",),
    "alignment": ("clustering",),
    "conservation": ("alignment",),
    "contrastive_conservation": ("panel", "conservation"),
    "primer_design": ("contrastive_conservation",),
    "inclusivity": ("primer_design", "qc"),
    "specificity": ("primer_design",),
    "ranking": ("primer_design", "inclusivity", "specificity"),
}
STAGES = tuple(NEEDS)


def dependencies(stage: str) -> tuple[str, ...]:
    """All stages that a stage rests on, in order."""
    found, todo = set(), list(NEEDS[stage])
    while todo:
        s = todo.pop()
        if s not in found:
            found.add(s)
            todo += NEEDS[s]
    return tuple(s for s in STAGES if s in found)


def descendants(stage: str) -> tuple[str, ...]:
    """All stages that rest on a stage, in order."""
    if stage not in NEEDS:
        raise KeyError(stage)
    return tuple(s for s in STAGES if stage in dependencies(s))


@dataclass(frozen=True)
class Policy:
    resume: bool = False
    from_step: str | None = None
    force_step: str | None = None

    def __post_init__(self):
        for s in (self.from_step, self.force_step):
            if s is not None and s not in NEEDS:
                raise ValueError(f"unknown stage {s!r}")
        if self.from_step and (self.resume or self.force_step):
            raise ValueError("from_step excludes resume and force_step")
        if self.force_step and not self.resume:
            raise ValueError("force_step requires resume")


def plan(policy: Policy, valid) -> dict[str, str]:
    """RUN, REUSE or FORCED for each stage. ``valid(stage)`` tells whether its checkpoint holds.

    Without resuming all run. From a step, it and what rests on it are forced, and what those need
    besides must hold, or nothing is planned; stages that none of them needs are left as they are.
    When resuming, a stage that is named, and all that rest on it, are forced; of the others those
    that don't hold run, which forces all that rest on them.
    """
    if policy.from_step:
        forced = {policy.from_step, *descendants(policy.from_step)}
        needed = {d for s in forced for d in dependencies(s)} - forced
        if bad := [s for s in STAGES if s in needed and not valid(s)]:
            raise ValueError(f"cannot start from {policy.from_step}: no valid checkpoint of {', '.join(bad)}")
        return {s: "FORCED" if s in forced else "REUSE" for s in STAGES}
    if not policy.resume:
        return dict.fromkeys(STAGES, "RUN")
    forced = {policy.force_step, *descendants(policy.force_step)} if policy.force_step else set()
    out = {}
    for s in STAGES:
        out[s] = "FORCED" if s in forced else "REUSE" if valid(s) else "RUN"
        if out[s] == "RUN":
            forced |= set(descendants(s))
    return out
