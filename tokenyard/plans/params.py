"""Parameters of the registered queries (shared by the Spark plans and their SQL oracles)."""

from ..functions.text import DEFAULT_SPECIAL

SPECIAL = DEFAULT_SPECIAL
CORPUS_MERGES = 8  # merges learned from `documents` for the corpus tokenizer
CANDIDATES = 32  # pairs considered per learner round
TOP_K = 20
WINDOW_LEN = 64
WINDOW_STRIDE = 64
BLOCK_SIZE = 1 << 16
HALO = 1024
N_SAMPLES = 512
SAMPLE_SEED = 1234
DRAW_SEED = 7
TEMPERATURE = 0.5
TOP_P = 0.9
EVAL_BATCH = 32
# Training-run stand-in derived from `events`: one run per user, one logged row per event.
BATCH_SIZE = 32
CONTEXT = 256
EVAL_EVENT = "purchase"  # rows that also carry a validation loss
REGISTER_EVENT = "signup"  # runs registered in the run index
LR_MAX, LR_MIN, WARMUP, CYCLE = 1e-3, 1e-4, 100, 10000
