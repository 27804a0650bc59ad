"""The isoform lookup: regular cells by the grammar of splice chains, the others from a table of fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COLUMNS = ("SpliceForm", "desc", "know_pattern", "check_size_class", "size_class", "step1", "step2", "step3", "step4", "step5", "step6", "step7", "step8c", "step8", "final_des", "splice_cat2")
ACCEPTORS = ("A3", "A4a", "A4b", "A4c", "A4d", "A5a", "A5b", "A7")
GENES = {"A3": "tat", "A4": "rev or env", "A5": "nef or env", "A7": "nef"}
CRYPTIC = "Cryptic Reads"
LONG = ("D1", "A1", "D2", "D2-unspliced", "D2b")
# ---- fixed values: cells that the grammar does not give, as the lookup has them; and shares of forms in mock data
IRREGULAR = {
    "D1_A1_D2_D2-unspliced_D2b_A2_noD3": {"desc": "potential vpr, incomplete"},
    "D1_A1_D2_A2_noD3": {"step5": "", "step6": "Incomplete"},
    "D1_A1_D2_unknown": {"desc": "unknown after D2b"},
    "D1_A2_noD3": {"desc": "incomplete", "know_pattern": "incomplete"},
}
SHARE_NO_D1, SHARE_UNSPLICED, SHARE_EACH = 0.427350427, 0.042735043, 0.008547009
# ---- end of fixed values


def short(acceptor: str) -> str:
    """A4a and the like as A4."""
    return acceptor[:2] if acceptor[:1] == "A" else acceptor


def _row(path: tuple[str, ...], last: str, desc: str, known: str, sized: str, shown: str, goal: str) -> dict[str, str]:
    """A form: steps of the path, then what the end shows; after seven steps the end is the eighth."""
    row = {"SpliceForm": "_".join((*path, last)), "desc": desc, "know_pattern": known, "check_size_class": sized}
    row |= {f"step{i + 1}": s for i, s in enumerate((*path, shown))}
    whole = goal == "Incomplete"
    row |= {"step8c": "Incomplete" if whole else last, "final_des": goal, "splice_cat2": "Incomplete" if whole else "_".join((*path, short(last)))}
    return row


def forms() -> list[dict[str, str]]:
    """All known forms, in the order of their chains' branches."""
    out = [
        {"SpliceForm": "unknown", "desc": "unknown, discard", "know_pattern": "NoD1", "check_size_class": "N", "step1": "D1 absent", "splice_cat2": "Unknown"},
        {"SpliceForm": "unspliced", "desc": "unspliced, gag", "know_pattern": "Yes", "check_size_class": "N", "step1": "D1", "step2": "gag", "splice_cat2": "Unspliced"},
    ]

    def ends(path: tuple[str, ...], cryptic: bool, unknown: bool = True, last: bool = True) -> None:
        for a in ACCEPTORS[: None if last else -1]:
            row = _row(path, a, GENES["A7"] if a == "A7" else CRYPTIC if cryptic else GENES[short(a)], "Yes", "N" if a == "A7" else "Y", short(a), short(a))
            if a == "A7":
                row["size_class"] = "1.8kb"
            out.append(row)
        if unknown:
            out.append(_row(path, "unknown", f"unknown after {path[-1]}", "No", "N", "Incomplete", "Incomplete"))

    def after_a2(path: tuple[str, ...], cryptic: bool) -> None:
        out.append(_row(path, "noD3", "Incomplete", "Incomplete", "Y", "Incomplete", "Incomplete"))
        out.append(_row((*path, "D3"), "D3-unspliced", "vpr", "Yes", "Y", "D3-unspliced", "vpr"))
        ends((*path, "D3"), cryptic)

    out.append(_row(LONG[:4], "noD2b", "potential vif, incomplete", "Incomplete", "Y", "Incomplete", "Incomplete"))
    out.append(_row(LONG, "D2b-unspliced", "vif", "Yes", "Y", "D2b-unspliced", "vif"))
    after_a2((*LONG, "A2"), True)
    ends(LONG, True, last=False)
    after_a2(("D1", "A1", "D2", "A2"), False)
    ends(("D1", "A1", "D2"), False)
    out.append(_row(("D1", "A1"), "noD2", "Incomplete", "Incomplete", "Y", "Incomplete", "Incomplete"))
    after_a2(("D1", "A2"), False)
    ends(("D1",), False, unknown=False)
    return [{c: (r | IRREGULAR.get(r["SpliceForm"], {})).get(c, "") for c in COLUMNS} for r in out]


def lookup(spark: SparkSession) -> DataFrame:
    """The lookup as a small table; empty cells are NULL."""
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame([tuple(r[c] or None for c in COLUMNS) for r in forms()], schema)


def mock_ratios(no_d1: float = SHARE_NO_D1, unspliced: float = SHARE_UNSPLICED, each: float = SHARE_EACH) -> dict[str, float]:
    """Shares of the forms in mock data: one for missing D1, one for unspliced reads, one for every other form."""
    spliced = [r["SpliceForm"] for r in forms() if r["SpliceForm"] not in ("unknown", "unspliced")]
    return {"noD1": no_d1, "D1_D1-unspliced": unspliced, "D1_unknown": each} | dict.fromkeys(spliced, each)
