"""Defaults, word lists, templates and prices that decide results."""

from __future__ import annotations

# Quality metrics scored and averaged by default.
DEFAULT_METRICS = ("instruction_complexity", "response_quality", "reasoning_depth", "safety_score")

# Default thresholds of the quality gate.
GATE_THRESHOLDS = {"overall_score": 0.7, "safety_score": 0.9, "reasoning_depth": 0.6}
SAFETY_THRESHOLD = 0.9
OVERALL_THRESHOLD = 0.7
RATIONALE_THRESHOLD = 0.7
ANSWER_THRESHOLD = 0.7

# Length limits of ingest validation and of the filter on generated samples.
MIN_INSTRUCTION_LENGTH = 10
MIN_RESPONSE_LENGTH = 10
FILTER_MIN_LENGTH = 50
FILTER_MAX_LENGTH = 2000

# Keywords that mark a task kind, matched as lower-case substrings.
CODE_CLAIM_WORDS = ("code", "function", "program")
CODE_TASK_WORDS = ("code", "function", "program", "implement")
MATH_TASK_WORDS = ("calculate", "compute", "solve", "equation", "math")

# Messages of the verification results.
NOT_CODE = "Not a code task"
NO_CODE = "No code found in response"
CODE_OK = "Code execution successful"
NOT_MATH = "Not a math task"
NO_ANSWER = "Could not extract answer"
MATH_OK = "Math validation successful"
MATH_BAD = "Math validation failed"

# Diversity weights, selection weight and difficulty shares.
DIVERSITY_WEIGHTS = {"domain": 0.4, "difficulty": 0.3, "content": 0.3}
DIVERSITY_WEIGHT = 0.3
TARGET_SIZE = 1000
DIFFICULTY_SHARES = {"easy": 0.3, "medium": 0.5, "hard": 0.2}
ENSEMBLE_WEIGHTS = {"ifd": 0.4, "limr": 0.3, "less": 0.3}
SIMILARITY_THRESHOLD = 0.85
DIFFICULTY_BUCKETS = 5
HISTORY_SIZE = 100

# Prompt templates for generation, by name.
TEMPLATES = {
    "basic_generation": """
You are an AI assistant helping to generate high-quality instruction-response pairs for AI training.
Based on the example below, generate a new, unique instruction-response pair that follows a similar pattern but is not a duplicate.

Example:
Instruction: {instruction}
Response: {response}

Generate a new instruction-response pair:
""",
    "domain_specific": """
You are an AI assistant helping to generate high-quality instruction-response pairs for AI training in the domain of {domain}.
The difficulty level should be approximately {difficulty} on a scale of 0 to 1, where 0 is very easy and 1 is very challenging.

Based on the example below, generate a new, unique instruction-response pair that follows a similar pattern but is not a duplicate.

Example:
Instruction: {instruction}
Response: {response}

Generate a new instruction-response pair in the {domain} domain:
""",
    "complex_reasoning": """
You are an AI assistant helping to generate high-quality instruction-response pairs that require complex reasoning.
The generated pair should require multi-step reasoning, careful analysis, and detailed explanation.

Based on the example below, generate a new, unique instruction-response pair that follows a similar pattern but is not a duplicate.

Example:
Instruction: {instruction}
Response: {response}

Generate a new instruction-response pair that requires complex reasoning:
""",
}

# Prices as (model, unit, prompt, completion).
PRICES = (
    ("gpt-4-turbo", "1k_tokens", 0.01, 0.03),
    ("gpt-4", "1k_tokens", 0.03, 0.06),
    ("gpt-3.5-turbo", "1k_tokens", 0.0015, 0.002),
    ("claude-3-opus-20240229", "1k_tokens", 0.015, 0.075),
    ("claude-3-sonnet-20240229", "1k_tokens", 0.003, 0.015),
    ("claude-3-haiku-20240307", "1k_tokens", 0.00025, 0.00125),
    ("deepseek-chat", "1m_tokens", 0.14, 0.28),
    ("deepseek-coder", "1m_tokens", 0.14, 0.28),
    ("gemini-1.5-pro-latest", "1k_chars", 0.0125, 0.0375),
    ("gemini-1.5-flash-latest", "1k_chars", 0.00125, 0.0025),
    ("gemini-1.0-pro", "1k_chars", 0.125, 0.375),
)

# Chat roles of the two-role message format.
ROLE_NAMES = {"system": "user", "user": "user", "assistant": "model", "tool": "function"}

# Judge criteria, scored 1 to 5.
JUDGE_CRITERIA = ("clarity", "coherence", "accuracy", "relevance")

# Characters removed by a Unicode-aware strip.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
