"""What differs between model providers: how tools are described to them, and where replies tell their usage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schema keys that one dialect doesn't know, where replies hold the tokens, and each provider's credential.
UNKNOWN_KEYS = ("additionalProperties", "minimum", "maximum", "minItems", "maxItems")
USAGE = {
    "gemini": ("$.usageMetadata.promptTokenCount", "$.usageMetadata.candidatesTokenCount"),
    "claude": ("$.usage.input_tokens", "$.usage.output_tokens"),
    "gpt": ("$.usage.input_tokens", "$.usage.output_tokens"),
}
CREDENTIALS = {"gpt": "OPENAI_API_KEY", "grok": "XAI_API_KEY", "together": "TOGETHER_API_KEY", "gemini": "GEMINI_API_KEY", "claude": "ANTHROPIC_API_KEY"}
NO_PARAMETERS = {"type": "object", "properties": {}}


def plain_schema(schema: object) -> object:
    """A JSON schema without the keys that are unknown there; a union of types becomes its first one that isn't null."""
    if isinstance(schema, list):
        return [plain_schema(s) if isinstance(s, dict) else s for s in schema]
    if not isinstance(schema, dict):
        return schema
    kept = {k: v for k, v in schema.items() if k not in UNKNOWN_KEYS}
    return {k: next((t for t in v if t != "null"), "string") if k == "type" and isinstance(v, list) else plain_schema(v) for k, v in kept.items()}


def described(tools: list[dict], dialect: str) -> list[dict]:
    """The function tools (type, name, description, parameters) as a provider wants them; other entries are left out."""
    out = []
    for tool in (t for t in tools if t.get("type") == "function"):
        about = {"name": tool["name"], "description": tool.get("description", "")}
        parameters = tool.get("parameters", NO_PARAMETERS)
        match dialect:
            case "chat":
                out.append({"type": "function", "function": {**about, "parameters": parameters}})
            case "gemini":
                out.append({**about, "parameters": plain_schema(parameters)})
            case "claude":
                out.append({**about, "input_schema": parameters})
            case _:
                raise ValueError(f"no dialect {dialect!r}")
    return out


def usage_of(reply: Column, provider: str) -> Column:
    """Input and output tokens of a raw reply's JSON; 0 where it doesn't tell, or where the provider isn't known."""
    at = [F.coalesce(F.get_json_object(reply, path).try_cast("long"), F.lit(0)) for path in USAGE.get(provider, ("$.none", "$.none"))]
    return F.struct(at[0].alias("input_tokens"), at[1].alias("output_tokens"))
