"""A workspace's folders and index files: the plan and the findings as rows, the writing through Spark's file systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MARK = "<!-- bootstrap-generated -->"
# Layers with folder pattern and purpose, shared folders, seeds and the sections that an index needs.
LAYERS = [
    ("00", "00_raw_{domain}", "Immutable source storage with provenance metadata."),
    ("10", "10_md_{domain}", "Normalized markdown converted from raw sources."),
    ("20", "20_chapter_{domain}", "Semantic chapter segmentation from markdown documents."),
    ("30", "30_chunk_{domain}", "Self-contained retrieval chunks with stable IDs."),
    ("40", "40_index_{domain}", "Evidence index with scoring and relationship links."),
    ("50", "50_embedding_{domain}", "Vector embeddings for semantic retrieval."),
    ("60", "60_wiki_{domain}", "Topic-oriented wiki pages with evidence references."),
    ("70", "70_personal_{domain}_data", "Private context data for personalization."),
    ("80", "80_{domain}_analysis", "Evidence-backed analysis outputs and recommendations."),
    ("90", "90_{domain}_skills", "Reusable prompts, skills, and reasoning patterns."),
]
SHARED = ("personas", "tools")
SEEDS = {"70": ("user_profile.md", "preferences.md"), "80": ("analysis_template.md",), "90": ("prompt_library.md", "reasoning_patterns.md"), "personas": ("default_persona.md",)}
SECTIONS = ("#", "## Purpose", "## Input", "## Output", "## Upstream", "## Downstream", "## Quality Checklist")


def index_text(folder: str, purpose: str, before: str, after: str) -> str:
    body = {"## Purpose": purpose, "## Input": before or "external files", "## Output": folder, "## Upstream": before or "none", "## Downstream": after or "none", "## Quality Checklist": "- [ ] checked"}
    return "\n\n".join([MARK, f"# {folder}", *(f"{k}\n\n{v}" for k, v in body.items())]) + "\n"


def plan(domain: str, seeds: bool = False) -> list[tuple[str, str, str]]:
    """(path, kind, text) of all folders and files."""
    names = [f.format(domain=domain) for _, f, _ in LAYERS]
    out = []
    for i, (number, _, purpose) in enumerate(LAYERS):
        around = names[i - 1] if i else "", names[i + 1] if i + 1 < len(names) else ""
        out += [(names[i], "folder", ""), (f"{names[i]}/INDEX.md", "index", index_text(names[i], purpose, *around))]
        out += [(f"{names[i]}/{s}", "seed", f"{MARK}\n\n# {s[:-3]}\n") for s in SEEDS.get(number, ()) if seeds]
    for name in SHARED:
        out.append((name, "folder", ""))
        out += [(f"{name}/{s}", "seed", f"{MARK}\n\n# {s[:-3]}\n") for s in SEEDS.get(name, ()) if seeds]
    return out


def plan_rows(spark: SparkSession, domain: str, seeds: bool = False) -> DataFrame:
    return spark.createDataFrame([x[:2] for x in plan(domain, seeds)], "path string, kind string")


def create(spark: SparkSession, root: str, domain: str, seeds: bool = False, force: bool = False) -> list[tuple[str, str]]:
    """Writes the plan: (path, created, kept or replaced). With force only files that carry the mark are replaced."""
    fs, out = None, []
    jvm = spark._jvm
    for name, kind, text in plan(domain, seeds):
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.setWriteChecksum(False)  # people edit these files, side files would go stale
        there = fs.exists(path)
        if kind == "folder":
            fs.mkdirs(path)
            out.append((name, "kept" if there else "created"))
            continue
        ours = there and any(MARK in r.value for r in spark.read.text(path.toString()).limit(1).collect())
        if there and not (force and ours):
            out.append((name, "kept"))
            continue
        stream = fs.create(path, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        out.append((name, "replaced" if there else "created"))
    return out


def missing_sections(text: str) -> list[str]:
    lines = [x.strip() for x in text.splitlines()]
    return [s for s in SECTIONS if not any(x == s or s == "#" and x.startswith("# ") for x in lines)]
