"""Fixed values that must equal the original system's for equal results."""

# --- fixed values (kept as the original system defines them) ---
RATING_LOG_PREFIX = "PRODUCT_RATING_PREFIX:"  # marker in application log lines
RECENT_QUEUE_SIZE = 40          # per-user recent-rating queue length
RECENT_READ_N = 21              # queue entries read by the online job (0..20 inclusive)
MAX_SIM_PRODUCTS = 20           # candidates taken from the trigger's similarity list
USER_MAX_RECOMMENDATION = 20    # offline per-user list length
ALS_RANK, ALS_ITERATIONS, ALS_LAMBDA = 5, 10, 0.01
PRODUCT_SIM_THRESHOLD = 0.6     # item-factor cosine kept when strictly above
STREAM_SIM_THRESHOLD = 0.4      # recent/candidate similarity used when strictly above
HIGH_SCORE = 3.0                # scores strictly above count as "high"
TUNING_RANKS = (100, 200, 250)
TUNING_LAMBDAS = (1.0, 0.1, 0.01, 0.001)
TUNING_ITERATIONS = 10
TRAIN_FRACTION = 0.8
MS_EPOCH_CUTOFF = 100_000_000_000  # epoch values at or above are milliseconds
# --- end of fixed values ---
