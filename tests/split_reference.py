"""Splitting of one CIGAR in plain Python, to hold the expression against."""

import re

from lociframe.functions.cigar import OP


def merged(parts: list[tuple[int, str]]) -> str:
    """Adjacent equal operations joined, empty ones dropped."""
    out: list[list] = []
    for n, op in parts:
        if n and out and out[-1][1] == op:
            out[-1][0] += n
        elif n:
            out.append([n, op])
    return "".join(f"{n}{op}" for n, op in out)


def split_at_skips(cigar: str) -> list[tuple[str, int]]:
    """Each exon section of a spliced alignment as (cigar, reference offset); the whole CIGAR at 0 if it is not to be split.

    Bases of other sections become soft clips and the outer hard clips stay; a deletion at a section's edge goes.
    Without a section of aligned, inserted or deleted bases before some N nothing is split.
    """
    parts = [(int(n), op) for n, op in re.findall(OP, cigar)]
    sections: list[list[tuple[int, str]]] = [[]]
    starts, at = [0], 0
    for n, op in parts:
        at += n if op in "MDN=X" else 0
        if op == "N":
            sections.append([])
            starts.append(at)
        else:
            sections[-1].append((n, op))
    real = [any(op in "M=XID" for _, op in s) for s in sections]
    if not any(real[:-1]):
        return [(cigar, 0)]
    in_read = [sum(n for n, op in s if op in "MIS=X") for s in sections]
    head = parts[0][0] if parts[0][1] == "H" else 0
    tail = parts[-1][0] if parts[-1][1] == "H" and len(parts) > 1 else 0
    out = []
    for k, section in enumerate(sections):
        if not real[k]:
            continue
        body = [x for x in section if x[1] != "H"]
        offset = starts[k]
        lead = next(i for i, x in enumerate(body) if x[1] != "S")
        end = len(body) - next(i for i, x in enumerate(reversed(body)) if x[1] != "S")
        if all(op == "D" for _, op in body[lead:end]):
            raise ValueError(f"section {k} of {cigar} holds deletions only")
        while body[lead][1] == "D":
            offset += body.pop(lead)[0]
            end -= 1
        while body[end - 1][1] == "D":
            end -= 1
            body.pop(end)
        before, after = sum(in_read[:k]), sum(in_read[k + 1 :])
        out.append((merged([(head, "H"), (before, "S"), *body, (after, "S"), (tail, "H")]), offset))
    return out
