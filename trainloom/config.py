"""Job parameters and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These strings and numbers must stay exactly as written: the
# training records, prompts and reports are compared against them.
# ---------------------------------------------------------------------------
CODE_SYSTEM_PROMPT = (
    "You are a careful coding assistant. Think step by step inside "
    "<think> </think> tags, then output the final solution as a single Python "
    "code block:\n```python\n# your code here\n```\n"
    "Define the requested function(s) at module top level."
)
CHAT_SYSTEM_PROMPT = (
    "You are a careful coding assistant. Answer directly and "
    "concisely. When the task is to write code, put the final solution in a "
    "single Python code block."
)
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
FENCE_PYTHON = "```python"
# ShareGPT speaker names -> message roles; anything else becomes "user".
ROLE_MAP = {"human": "user", "user": "user", "gpt": "assistant",
            "assistant": "assistant", "system": "system"}
STARTER_CODE_HEADER = "\n\nStarter code:\n```python\n"
PUBLIC_EXAMPLE_HEADER = "\n\nYour solution must satisfy this public example:\n"
COMPLETE_FUNCTION_PREFIX = "Complete this function:\n"
TESTS_HEADER = "\n\nTests:\n"
OBS_TESTS_FAILED = "Tests failed. Runtime output:\n"
OBS_EXEC_ERROR = "Execution error:\n"
OBS_FIX_SUFFIX = "\nFix the code and return the full corrected solution."
OBS_MAX_CHARS = 800
REPAIR_RATIONALE = (
    "The previous attempt fails the public test above. Re-reading "
    "the problem and comparing against the example, the bug is a "
    "small logic error (a comparison/boundary/helper-function "
    "mistake). Fixing that and re-checking against the example "
    "gives the corrected solution below."
)
FAILURE_TRACE_HEAD = "Ran the public test:\n    "
FAILURE_TRACE_MID = ("\n\nTraceback (most recent call last):\n"
                     "  File \"solution.py\", line 1, in <module>\n    ")
FAILURE_TRACE_TAIL = "\nAssertionError"
# One-bug mutation rules: (pattern, replacement), tried in a seeded order.
BUG_RULES = [
    (r"<=", "<"),
    (r">=", ">"),
    (r"(?<![=!<>])==(?!=)", "!="),
    (r"\breturn True\b", "return False"),
    (r"\breturn False\b", "return True"),
    (r"\bmin\(", "max("),
    (r"\bmax\(", "min("),
    (r"\bsorted\(", "list("),
    (r"\+ 1\b", "- 1"),
    (r"- 1\b", "+ 1"),
]
# Chat template pieces (user/assistant headers as used for response-only loss).
TEMPLATE_BOS = "<|begin_of_text|>"
TEMPLATE_HEADER_OPEN = "<|start_header_id|>"
TEMPLATE_HEADER_CLOSE = "<|end_header_id|>\n\n"
TEMPLATE_EOT = "<|eot_id|>"
SHUFFLE_SEED = 3407
MAX_SEQ_LENGTH = 2048
NUM_GENERATIONS = 4
MAX_COMPLETION_LENGTH = 512
TRUNCATION_FRACTION = 0.98
ZERO_VARIANCE_EPS = 1e-6
CURRICULUM_SAMPLE_SIZE = 48
MAX_ITERS = 3
MAX_TURNS = 8
CORRECTNESS_WEIGHT = 3.0
FORMAT_THINK_BONUS = 0.3
FORMAT_FENCE_BONUS = 0.2
SMOKE_MIN_ROWS = 100
SMOKE_ROWS_PER_ITEM = 4
# ---------------------------------------------------------------------------


@dataclass
class JobParams:
    """Tunable parameters of the dataset builders and reports."""

    seed: int = SHUFFLE_SEED
    max_seq_length: int = MAX_SEQ_LENGTH
    num_generations: int = NUM_GENERATIONS
    max_completion_length: int = MAX_COMPLETION_LENGTH
    curriculum_sample_size: int = CURRICULUM_SAMPLE_SIZE
    max_iters: int = MAX_ITERS
    max_turns: int = MAX_TURNS
    reasoning_domain: str = "code"
    reasoning_max_samples: int | None = 12_000
    general_max_samples: int | None = 4_000
    grpo_max_samples: int | None = 374
    repair_max_samples: int | None = 300
    # Rollouts per probed task that count in its verdict; sample size 0 turns the probe off.
    probe_generations: int = 2
    reward_weights: dict = field(default_factory=lambda: {"correctness": 1.0, "format": 1.0})
