"""Tool loops with scripted models, tool descriptions, usage of replies, and a run's settings."""

import json

import pytest
from pyspark.sql import functions as F

from quarrylit import agents, providers, settings
from quarrylit.agents import AUDIT, FIGURE, SCREENING, VERIFY, Call, Turn

PAGES = ["Title\nAbstract: We measured\n XRD of NiO.\nIntroduction\nmore", "", "Results here\nXRD again " + "x" * 400]


class Script:
    """Answers by its list of turns, then by nothing; a failure in the list is raised."""

    def __init__(self, *turns):
        self.turns, self.at = turns, 0

    def turn(self, messages, tools):
        self.at += 1
        got = self.turns[self.at - 1] if self.at <= len(self.turns) else Turn()
        if isinstance(got, Exception):
            raise got
        return got


def calls(*named):
    return Turn(tuple(Call(*n) for n in named), 10, 2)


def loop(kind, *turns, candidate=None, single=None):
    return agents.converse(kind, Script(*turns), PAGES, "go", candidate or {}, single, retries=1, pause=0, sleep=lambda s: None)


def test_tools():
    see = lambda tool, **args: agents.observed(agents.SCREENING_TOOLS, PAGES, Call(tool, args))
    assert see("get_abstract") == "We measured XRD of NiO."
    assert see("get_page_text", page=2) == "(page 2 empty)" and see("get_page_text", page=4) == "(error: page 4 out of range 1..3)"
    assert [see("get_page_text", **a) for a in ({"page": "2"}, {"page": 1.7}, {"page": None}, {})] == ["(error: page must be int)"] * 4 and see("get_page_text", page=0) == "(error: page 0 out of range 1..3)"
    assert see("other") == "(error: unknown tool other)"
    assert [h["page"] for h in json.loads(see("search_pdf", pattern="xrd"))] == [1, 3] and see("search_pdf", pattern="nothing") == "(no matches)"
    assert see("search_pdf") == "(error: empty pattern)" and see("search_pdf", pattern="(").startswith("(error: bad regex:")
    assert len(json.loads(see("search_pdf", pattern="x"))) == agents.HITS
    assert [h["heading"] for h in json.loads(see("get_toc"))] == ["Abstract", "Introduction", "Results"]
    assert agents.abstract([], {}) == "(empty page 1)" and agents.headings([], {}) == "(no table of contents available)"
    assert agents.abstract(["plain " * 500], {}) == ("plain " * 500)[: agents.TOP]


def test_screening():
    got = loop(SCREENING, calls(("search_pdf", {"pattern": "XRD"})), calls(("finalize", {"decision": " Keep", "reason": "confidence: 0.9"})))
    assert got["final"] == {"decision": "keep", "confidence": 0.9, "reason": "confidence: 0.9"} and [t[1] for t in got["trace"]] == ["search_pdf", "finalize"]
    assert (got["input_tokens"], got["output_tokens"]) == (20, 4)
    assert loop(SCREENING)["final"] == {"decision": "reject", "confidence": 0.0, "reason": "Budget exhausted after 0 tool calls."}
    assert loop(SCREENING, *[calls(("get_toc", {}))] * 9)["final"]["reason"] == "Budget exhausted after 6 tool calls."
    finals = [({"decision": "keep", "confidence": 7}, ("keep", 1.0)), ({"decision": "maybe", "confidence": "x"}, ("reject", 0.0)), ({}, ("reject", 0.75))]
    assert [(f["decision"], f["confidence"]) for f in (loop(SCREENING, calls(("finalize", a)))["final"] for a, _ in finals)] == [x for _, x in finals]


def test_failures_and_nudges():
    assert loop(SCREENING, ValueError("once"), calls(("finalize", {"decision": "keep"})))["final"]["decision"] == "keep"
    with pytest.raises(ValueError, match="twice"):
        loop(SCREENING, ValueError("once"), ValueError("twice"))
    assert loop(VERIFY, ValueError("once"), ValueError("twice"), candidate={"a": ["x"]})["final"] == {"a": {"value": [], "evidence_span": ""}}
    nudged = agents.Kind("screening", agents.SCREENING_TOOLS, agents.screened, SCREENING.used_up, nudges=agents.NUDGES, single_pass=True)
    got = loop(nudged, single=lambda pages: {"decision": "keep", "confidence": 0.5, "reason": "r"})
    assert got["final"] == {"decision": "keep", "confidence": 0.5, "reason": "[single-pass fallback] r"}
    assert [t[1] for t in got["trace"]] == ["(nudge)", "(nudge)", "(single-pass-fallback)"]
    got = loop(SCREENING, *[calls(("get_toc", {}))] * 9, single=lambda pages: {"decision": "keep", "confidence": 0.5, "reason": "r"})
    assert got["final"]["reason"] == "[single-pass fallback] r" and len(got["trace"]) == 7  # all steps used, never finalized
    assert loop(AUDIT, single=lambda pages: {}, candidate={"a": "x"})["final"]["verified_fields"]["a"]["status"] == "unclear"


def test_retries():
    """Three tries after the first."""
    tried = []

    def fails():
        tried.append(1)
        raise ValueError

    with pytest.raises(ValueError):
        agents.retried(fails, pause=0, sleep=lambda s: None)
    assert len(tried) == 4


def test_what_finalize_becomes():
    got = loop(FIGURE, calls(("finalize", {"matched_fig_num": "3", "is_xrd": 1, "confidence_xrd": 2, "xrd_data_type": "Both"})))["final"]
    assert (got["matched_fig_num"], got["is_xrd"], got["confidence_xrd"], got["xrd_data_type"], got["plot_info"]) == (3, True, 1.0, "both", {})
    assert loop(FIGURE)["final"]["reason_match"] == "Budget exhausted after 0 steps." and loop(FIGURE)["final"]["xrd_data_type"] == "unclear"
    was = {"radiation": "Cu", "phases": ["NiO"], "cell": {"a": 1}}
    got = loop(VERIFY, calls(("finalize", {"radiation": {"value": 5, "evidence_span": None}, "phases": {"value": ["NiO"], "evidence_span": "e"}, "other": {"value": "x"}})), candidate=was)["final"]
    assert got == {"radiation": {"value": "", "evidence_span": ""}, "phases": {"value": ["NiO"], "evidence_span": "e"}, "cell": {"value": {}, "evidence_span": ""}}
    got = loop(AUDIT, calls(("finalize", {"verified_fields": {"radiation": {"status": "supported", "corrected_value": "Cu Ka"}, "phases": {"status": "?"}}})), candidate=was)["final"]["verified_fields"]
    assert [(f["status"], f["corrected_value"]) for f in got.values()] == [("supported", "Cu Ka"), ("unclear", []), ("unclear", [])]
    assert {f["status"] for f in loop(AUDIT, calls(("finalize", {"verified_fields": 1})), candidate=was)["final"]["verified_fields"].values()} == {"unclear"}


class Words:
    """Keeps what its search finds; fails on the task `fail`."""

    def turn(self, messages, tools):
        if messages[0]["content"] == "fail":
            raise RuntimeError("down")
        if len(messages) == 1:
            return calls(("search_pdf", {"pattern": "XRD"}))
        return calls(("finalize", {"decision": "reject" if "no matches" in messages[-1]["content"] else "keep", "confidence": 1}))


def test_loops_over_a_table(spark):
    rows = [("a", PAGES, "t", None, 1), ("b", ["nothing"], "t", "{broken", 2), ("c", None, None, "[]", 3), ("d", [None], "fail", "{}", 4), (None, [], "t", "{}", 5)]
    requests = spark.createDataFrame(rows, "key string, pages array<string>, task string, candidate string, error int")
    got = {r.key: r for r in agents.run(requests, SCREENING, Words(), retries=0).collect()}
    assert {k: json.loads(r.final)["decision"] if r.final else r.error for k, r in got.items()} == {"a": "keep", "b": "reject", "c": "reject", "d": "RuntimeError: down", None: "reject"}
    assert (got["a"].steps_used, got["a"].input_tokens, got["a"].trace[0].tool, got["d"].trace) == (2, 20, "search_pdf", [])
    assert agents.run(requests.limit(0), SCREENING, Words()).count() == 0


def test_descriptions_and_usage(spark):
    tool = {"type": "function", "name": "t", "description": "d", "parameters": {"type": "object", "properties": {"n": {"type": ["integer", "null"], "minimum": 1}, "m": {"type": ["null"]}}, "additionalProperties": False, "anyOf": [{"maximum": 2}, 3]}}
    assert providers.described([tool, {"type": "other"}], "chat") == [{"type": "function", "function": {k: tool[k] for k in ("name", "description", "parameters")}}]
    assert providers.described([tool], "claude")[0]["input_schema"] == tool["parameters"]
    assert providers.described([tool], "gemini")[0]["parameters"] == {"type": "object", "properties": {"n": {"type": "integer"}, "m": {"type": "string"}}, "anyOf": [{}, 3]}
    assert providers.described([{"type": "function", "name": "t"}], "claude")[0]["input_schema"] == providers.NO_PARAMETERS
    with pytest.raises(ValueError):
        providers.described([tool], "other")
    replies = spark.createDataFrame([('{"usage":{"input_tokens":3,"output_tokens":null},"usageMetadata":{"promptTokenCount":5,"candidatesTokenCount":6}}',), ("not json",), (None,)], "reply string")
    got = replies.select(*(providers.usage_of(F.col("reply"), p).alias(p) for p in ("claude", "gemini", "other"))).collect()
    assert [tuple(r[0]) + tuple(r[1]) + tuple(r[2]) for r in got] == [(3, 0, 5, 6, 0, 0), (0,) * 6, (0,) * 6]


def test_settings():
    of = lambda *argv, **environ: settings.resolve(list(argv), environ)[1]
    assert of() == {} and of(X="1") == {"X": "1"}
    assert of("--full-run", "--skip-screening", "--skip-download") == dict.fromkeys(settings.STEPS, "true") | {"RUN_PHASE0_FILTER": "false", "RUN_DOWNLOAD": "false"}
    assert [k for k, v in of("--steps", "Phase1, step3").items() if v == "true"] == ["RUN_PHASE1", "RUN_JSON_VERIFY_AGENT"]
    assert of("--sources", "arxiv") == {"USE_ARXIV": "1", "USE_SPRINGER": "0", "USE_ELSEVIER": "0", "USE_CROSSREF": "0"}
    assert of("-n", "3", "--provider", "claude", "--model", "m") == {"TARGET_DOWNLOADS": "3", "PROVIDER": "claude", "MODEL": "m"}
    assert of("-i", "d", "--set", "RUN_DOWNLOAD=a=b") == {"OUTPUT_PDF_DIR": "d", "RUN_DOWNLOAD": "a=b"}
    for bad in (["--steps", "bogus"], ["--sources", "x"], ["--set", "x"], ["--provider", "x"]):
        with pytest.raises(SystemExit):
            of(*bad)
    assert [settings.flag({"A": w}, "A") for w in ("Yes", "on ", "2", "")] == [True, True, False, False] and settings.flag({}, "RUN_DOWNLOAD")
    assert [settings.number({"A": w}, "A", 9) for w in ("true", "off", "2.9", " ")] == [1, 0, 2, 9]
    with pytest.raises(SystemExit):
        settings.number({"A": "many"}, "A")
    assert settings.keywords({"ELEMENTS": "Fe", "TECHNIQUE": "XRD"}) == "((Fe) AND (XRD))" and settings.keywords({"SEARCH_KEYWORDS": "q"}) == "q"
    text = settings.dry_run(of("--skip-download", "--single-pass", "--set", "PHASE1_MODEL=x"))
    assert "Steps on: Step 0\n" in text and "single-pass" in text and "Override: PHASE1_MODEL=x" in text and "download skipped" in text
    assert "2 per source of arxiv" in settings.dry_run({})


def test_command_and_label():
    run = {"master_switches": {"RUN_DOWNLOAD": True, "RUN_PHASE1": True}, "download_sources": {"USE_ARXIV": 1, "TARGET_DOWNLOADS": 2, "REQUIRE_CC_LICENSE": True}, "search": {"ELEMENTS": "Fe"}, "model": {"MODEL": "m"}, "agentic": {"DISABLE_ALL_AGENTS": True}}
    assert settings.command(run) == 'quarrylit --steps download,step1 --sources arxiv -n 2 --elements "Fe" --model m --cc-only --single-pass'
    assert settings.command({"master_switches": dict.fromkeys(settings.STEPS, True)}) == "quarrylit --full-run" and settings.command({}) == "quarrylit --steps "
    assert settings.run_label("2024-03-05T14:07:09", "/x/r") == "Run of 5 Mar 2024, 14:07" and settings.run_label(None, "/x/r/") == "Run r"
