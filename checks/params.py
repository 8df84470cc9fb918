"""Parameter values shared by the registered queries and their oracles.

Prompt wording here is our own short test wording; templates are a parameter
of the library, never built in.
"""

from shardloom.sources.tables import RUN_CONFIGS  # noqa: F401

START = "2015-03-01"
END = "2018-06-30"
STEP = 2

SYSTEM_PROMPT = "You draft patent applications, one section at a time."
USER_TEMPLATE = "Class {ipc_code}. Title: {title}\nWrite the full application."
ASSISTANT_TEMPLATE = "{patent_text}"
QA_SYSTEM_TEXT = 'Answer with JSON only, shaped like {"claims": [{"id": 1, "risk": "low"}]}.'
QA_USER_TEMPLATE = "Patent:\n{patent_text}\nList the claims at risk."

LABEL_PREFIX = "FR"
TRAIN = ("2016-01-01", "2016-03-01")
VAL = ("2016-03-01", "2016-04-01")
SCAN = ("1996-01-01", "1996-07-01")
N_SAMPLES = 5

MAX_LEN = 64_000  # length cap of the build
LENGTH_CAP = 8_192  # cap of the length-filter query alone, which fixture documents reach
BLOCK = 2_048  # write-time block
CHUNK = 3_968  # read-time window (demo job sequence length)

WORKERS = 4
BATCH = 8
SEED = 42
EPOCH = 0
FEED_EPOCHS = 3
RESUME_BATCH = 5
WORLD = 2
FILE_BATCHES = 4
RESUME_SLOT = 6
DEMO_SHARDS = 2

# training log
LOG_EPOCHS = 2
ACCUM = 16
UPDATE_FREQ = 10
PROCS = 2
MICRO_BATCH = 8
TOKENS_PER_MICRO_STEP = CHUNK * PROCS * MICRO_BATCH
PPL_CLAMP = 20.0
DEMO_STEPS = 20
LOG_CUTS = ("2024-01-09", "2024-01-22")  # slices of the log that are folded in one after another
