"""Schemas of the record types and tables."""

from __future__ import annotations

from pyspark.sql import types as T


_SIMPLE = {"string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "date": T.DateType, "timestamp": T.TimestampType}


def _split(text: str) -> list[str]:
    """Parts between the commas that stand in no brackets."""
    parts, depth = [""], 0
    for c in text:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return [p.strip() for p in parts]


def _type(text: str) -> T.DataType:
    if text.startswith("array<"):
        return T.ArrayType(_type(text[6:-1]))
    if text.startswith("struct<"):
        return T.StructType([T.StructField(n, _type(k)) for n, k in (p.split(":", 1) for p in _split(text[7:-1]))])
    return _SIMPLE[text]()


def _schema(ddl: str) -> T.StructType:
    """Like StructType.fromDDL, which needs a running session."""
    return T.StructType([T.StructField(n, _type(k)) for n, k in (p.split(None, 1) for p in _split(ddl))])


NOTE = "struct<t:string,speaker:string,text:string>"
TRANSCRIPT = _schema(f"""
    meeting_id string, date date, company string, participants array<string>, desk string, notes array<{NOTE}>, source string,
    granola_note_id string, title string, creator_name string, creator_email string, calendar_event_title string,
    calendar_event_id string, calendar_event_time string, granola_link string, file_created_timestamp string,
    zapier_step_id string, enhanced_notes string, my_notes string, full_transcript string""")

CLIENT_INFO = "struct<client_id:string,client:string,domain:string,size:string,source:string>"
SECTION = "struct<qualified:boolean,reason:string,summary:string,evidence:string>"
FIT = "struct<qualified:boolean,reason:string,summary:string,services:array<string>,evidence:string>"
SALES = "struct<qualified:boolean,score:int,reason:string,evidence:string,coaching_note:string>"
TALENT_NOW = "struct<role:string,seniority:string,company_type:string,company_lifecycle:string,company_discipline:string,company_industry:string,current_employer_hiring_signal:boolean,employment_status:string>"
COMP = "struct<currency:string,amount_min:double,amount_max:double,period:string,basis:string,plausible:boolean>"
TALENT_MOTIVATION = "struct<primary_driver:string,better_description:string,employment_preference:string>"
TALENT_MARKET = f"struct<current_comp:string,expected_comp:string,current_comp_structured:{COMP},expected_comp_structured:{COMP},notice_period:string,openness_to_move:int,realistic_time_to_move:string>"
TALENT_LEADS = "struct<companies_mentioned:array<string>>"
COMPANY = "struct<name:string,type:string,sentiment:string,evidence_quote:string,source:string>"
THEME = "struct<company_name:string,theme:string,polarity:string,evidence_quote:string,source:string>"
BLOCKER = "struct<company_name:string,category:string,evidence_quote:string>"
FLAG = "struct<category:string,span:string,location:string,confidence:double,redacted:boolean,raw_scrub:string,redact_rounds:int>"

SALES_CRITERIA = ("introduction", "discovery", "scoping", "solution", "commercial", "case_studies", "next_steps", "strategic_context")
MEETING_INTEL = _schema(f"""
    meeting_id string, date date, participants array<string>, desk string, source string, client_info {CLIENT_INFO},
    granola_note_id string, title string, creator_name string, creator_email string, calendar_event_title string,
    calendar_event_id string, calendar_event_time timestamp, granola_link string, file_created_timestamp bigint,
    zapier_step_id bigint, enhanced_notes string, my_notes string, full_transcript string,
    total_qualified_sections bigint, qualified boolean, now {SECTION}, next {SECTION}, measure {SECTION}, blocker {SECTION},
    fit {FIT}, challenges array<string>, results array<string>, offering string, scored_at timestamp, llm_model string,
    salesperson_name string, salesperson_email string, sales_total_score bigint, sales_total_qualified bigint, sales_qualified boolean,
    {", ".join(f"sales_{c} {SALES}" for c in SALES_CRITERIA)},
    sales_strengths array<string>, sales_improvements array<string>, sales_overall_coaching string, scoring_domain string,
    talent_now {TALENT_NOW}, talent_triggers array<string>, talent_motivation {TALENT_MOTIVATION}, talent_market {TALENT_MARKET},
    talent_leads {TALENT_LEADS}, talent_narrative string, mentioned_companies array<{COMPANY}>, perception_themes array<{THEME}>,
    articulated_blockers array<{BLOCKER}>, article9_flags array<{FLAG}>, article9_status string""")
MAPPINGS = _schema("variant_name string, canonical_name string, notes string, created_at timestamp, updated_at timestamp")
COST_LOG = _schema("log_id string, meeting_id string, scoring_domain string, model string, prompt_label string, tokens_in bigint, tokens_out bigint, cost_estimate_usd double, scored_at timestamp")

#: Columns that refuse nulls, and what columns have that an insert doesn't name.
REQUIRED = {"meeting_intel": ("meeting_id", "date", "source", "scored_at", "llm_model"), "mappings": ("variant_name", "canonical_name")}
DEFAULTS = {"mappings": {"created_at": "current_timestamp()", "updated_at": "current_timestamp()"}}

#: Columns of MEETING_INTEL by who writes them.
TEXTS = ("enhanced_notes", "my_notes", "full_transcript")
SHARED = tuple(MEETING_INTEL.names[1:5] + MEETING_INTEL.names[6:16] + ["scored_at", "llm_model", "scoring_domain"])
TALENT_ONLY = tuple(c for c in MEETING_INTEL.names if c.startswith(("talent_", "article9_")) or c in ("mentioned_companies", "perception_themes", "articulated_blockers"))
CLIENT_ONLY = tuple(c for c in MEETING_INTEL.names if c not in (*SHARED, *TEXTS, *TALENT_ONLY, "meeting_id"))
