"""A run's settings: flags over the environment over defaults, as one mapping of names to words; nothing global is changed."""

from __future__ import annotations

import argparse
import re
from collections.abc import Mapping

# Switches in the order of the steps with their flags' words, sources, defaults, providers, months.
STEPS = {"RUN_DOWNLOAD": "download", "RUN_PHASE0_FILTER": "step0", "RUN_PHASE1": "step1", "RUN_PHASE2": "step2", "RUN_JSON_CLEAN_AGENT": "clean", "RUN_JSON_VERIFY_AGENT": "step3"}
LABELS = {"RUN_DOWNLOAD": "Download", "RUN_PHASE0_FILTER": "Step 0", "RUN_PHASE1": "Step I", "RUN_PHASE2": "Step II", "RUN_JSON_CLEAN_AGENT": "JSON clean", "RUN_JSON_VERIFY_AGENT": "Step III"}
ALSO = {"phase0": "step0", "phase1": "step1", "phase2": "step2", "phase3": "step3"}
SOURCES = {"arxiv": "USE_ARXIV", "springer": "USE_SPRINGER", "elsevier": "USE_ELSEVIER", "crossref": "USE_CROSSREF"}
PROVIDERS = ("gpt", "gemini", "claude", "grok", "together")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
TRUE, FALSE = ("1", "true", "yes", "on"), ("0", "false", "no", "off")
DEFAULTS = {
    "RUN_DOWNLOAD": "true",
    "RUN_PHASE0_FILTER": "true",
    "USE_ARXIV": "1",
    "WRITE_RUN_REPORT": "true",
    "ELEMENTS": "Cu OR Copper",
    "TECHNIQUE": '"x-ray diffraction" OR "x ray diffraction" OR XRD OR PXRD OR "powder x-ray diffraction" OR "powder diffraction"',
    "TARGET_DOWNLOADS": "2",
    "PROVIDER": "gpt",
    "MODEL": "gpt-5.2",
}


def flag(settings: Mapping[str, str], name: str) -> bool:
    """A switch: on for 1, true, yes and on; off for any other word."""
    return settings.get(name, DEFAULTS.get(name, "")).strip().lower() in TRUE


def number(settings: Mapping[str, str], name: str, default: int = 0) -> int:
    """A whole number, where words for on and off are 1 and 0; blank is the default, anything else ends the run."""
    word = settings.get(name, DEFAULTS.get(name, "")).strip().lower()
    if word in TRUE or word in FALSE:
        return int(word in TRUE)
    try:
        return int(float(word)) if word else default
    except (ValueError, OverflowError):
        raise SystemExit(f"{name}={word!r} is not a number or a true/false value.") from None


def keywords(settings: Mapping[str, str]) -> str:
    """The search query: as set, else composed of the elements and the technique."""
    s = {**DEFAULTS, **settings}
    return s.get("SEARCH_KEYWORDS") or f"(({s['ELEMENTS']}) AND ({s['TECHNIQUE']}))"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarrylit", description="Runs the extraction; without flags, download and screening.")
    for name, about in (
        ("--full-run", "every step"),
        ("--skip-download", "use the documents that are there"),
        ("--skip-screening", "keep every document"),
        ("--cc-only", "Creative Commons documents only"),
        ("--single-pass", "one model call a step, no tool loops"),
        ("--dry-run", "print the settings and stop"),
        ("--embed-report", "put images into the report"),
        ("--no-report", "write no report"),
        ("--ui", "open the pages in a browser"),
    ):
        p.add_argument(name, action="store_true", help=about)
    for *names, about in (
        ("--steps", "steps to run, by commas"),
        ("-i", "--input-dir", "a folder of documents; nothing is downloaded"),
        ("--elements", "elements to search for"),
        ("--technique", "technique to search for"),
        ("--sources", "sources to use, by commas"),
        ("--model", "model's name"),
        ("-o", "--output-dir", "where results go"),
    ):
        p.add_argument(*names, help=about)
    p.add_argument("-n", "--downloads", type=int, help="documents a source")
    p.add_argument("--provider", choices=PROVIDERS)
    p.add_argument("--report", nargs="?", const=".", help="write the report of a run that is there, and stop")
    p.add_argument("--set", dest="overrides", action="append", default=[], metavar="NAME=VALUE", help="any setting; applied last")
    return p


def _listed(p: argparse.ArgumentParser, name: str, given: str, known: Mapping[str, str]) -> set[str]:
    words = {w.strip().lower() for w in given.split(",") if w.strip()}
    if unknown := sorted(words - known.keys()):
        p.error(f"--{name}s: unknown {name}(s): {', '.join(unknown)}")
    return {known[w] for w in words}


def resolve(argv: list[str], environ: Mapping[str, str] | None = None) -> tuple[argparse.Namespace, dict[str, str]]:
    """The flags as parsed, and the environment with what they set. Unknown steps and sources end the run."""
    p = parser()
    args = p.parse_args(argv)
    out = dict(environ or {})
    if args.full_run:
        out |= dict.fromkeys(STEPS, "true")
    if args.steps:
        words = {word: switch for switch, word in STEPS.items()}
        on = _listed(p, "step", args.steps, words | {other: words[word] for other, word in ALSO.items()})
        out |= {switch: "true" if switch in on else "false" for switch in STEPS}
    if args.sources:
        use = _listed(p, "source", args.sources, SOURCES)
        out |= {switch: "1" if switch in use else "0" for switch in SOURCES.values()}
    given = (
        ("RUN_DOWNLOAD", "false" if args.skip_download or args.input_dir is not None else None),
        ("RUN_PHASE0_FILTER", "false" if args.skip_screening else None),
        ("OUTPUT_PDF_DIR", args.input_dir),
        ("OUTPUT_DIR", args.output_dir),
        ("TARGET_DOWNLOADS", args.downloads),
        ("ELEMENTS", args.elements),
        ("TECHNIQUE", args.technique),
        ("REQUIRE_CC_LICENSE", "true" if args.cc_only else None),
        ("PROVIDER", args.provider),
        ("MODEL", args.model),
        ("DISABLE_ALL_AGENTS", "true" if args.single_pass else None),
        ("WRITE_RUN_REPORT", "false" if args.no_report else None),
    )
    out |= {name: str(value) for name, value in given if value is not None}
    for item in args.overrides:
        name, equals, value = item.partition("=")
        if not equals:
            p.error(f"--set expects KEY=VALUE, got: {item!r}")
        out[name.strip()] = value
    return args, out


def dry_run(settings: Mapping[str, str]) -> str:
    """What a run with these settings would do, as text."""
    s = {**DEFAULTS, **settings}
    on = [LABELS[x] for x in STEPS if flag(s, x)]
    lines = [f"Output: {s.get('OUTPUT_DIR', '')}", f"Steps on: {' -> '.join(on) or '(none)'}", f"Steps off: {', '.join(v for v in LABELS.values() if v not in on) or '(none)'}"]
    if flag(s, "RUN_DOWNLOAD"):
        lines += [f"Download: {number(s, 'TARGET_DOWNLOADS')} per source of {', '.join(n for n, x in SOURCES.items() if number(s, x)) or '(none)'}", f"Search: {keywords(settings)}"]
    else:
        lines.append(f"Input: {s.get('OUTPUT_PDF_DIR', '')} (download skipped)")
    lines.append(f"Model: {s['PROVIDER']} {s['MODEL']}, {'single-pass' if flag(s, 'DISABLE_ALL_AGENTS') else 'agentic'}")
    own = sorted(x for x in settings if re.match(r"(PHASE[012]|VERIFY)_(.*_)?(PROVIDER|MODEL)$", x))
    return "\n".join([*lines, *(f"Override: {x}={settings[x]}" for x in own), *(["Licence: CC only"] if flag(s, "REQUIRE_CC_LICENSE") else [])])


def command(manifest: Mapping) -> str:
    """The command that a run's manifest is equivalent to."""
    steps, sources, search, model = (manifest.get(x) or {} for x in ("master_switches", "download_sources", "search", "model"))
    on = [word for switch, word in STEPS.items() if steps.get(switch)]
    used = [name for name, switch in SOURCES.items() if sources.get(switch)]
    options = (
        ("--sources {}", ",".join(used)),
        ("-n {}", sources.get("TARGET_DOWNLOADS")),
        ('--elements "{}"', search.get("ELEMENTS")),
        ('--technique "{}"', search.get("TECHNIQUE")),
        ("--provider {}", model.get("PROVIDER")),
        ("--model {}", model.get("MODEL")),
        ("--cc-only", sources.get("REQUIRE_CC_LICENSE")),
        ("--single-pass", (manifest.get("agentic") or {}).get("DISABLE_ALL_AGENTS")),
    )
    return " ".join(["quarrylit", "--full-run" if len(on) == len(STEPS) else "--steps " + ",".join(on), *(form.format(value) for form, value in options if value)])


def run_label(timestamp: str | None, folder: str) -> str:
    """A run's day and minute in words, else its folder's name."""
    m = re.match(r"(\d{4})-(\d{2})-(\d{2})T(\d{2}:\d{2})", timestamp or "")
    if m and 1 <= int(m.group(2)) <= 12:
        return f"Run of {int(m.group(3))} {MONTHS[int(m.group(2)) - 1]} {m.group(1)}, {m.group(4)}"
    return f"Run {folder.rstrip('/').rsplit('/', 1)[-1]}"
