"""Fixed values that must equal the modelled pipeline's for identical results.

Everything here is configuration, stated once in natural order. Operators take
these as default parameters, so callers can override them.
"""

from __future__ import annotations

# --- fixed values: side ids, keys and target -------------------------------
BLUE_SIDE = 100
RED_SIDE = 200
SIDES = (BLUE_SIDE, RED_SIDE)
SIDES_PER_GROUP = 2
GROUP_COL = "matchid"
SIDE_COL = "teamid"
KEYS = (GROUP_COL, SIDE_COL)
TARGET = "win"
SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.1
MIN_DURATION_SECONDS = 300

# --- fixed values: role vocabulary ------------------------------------------
ROLE_ALIASES = {
    "top": "top",
    "solo": "top",
    "jungle": "jungle",
    "jungler": "jungle",
    "mid": "mid",
    "middle": "mid",
    "bot": "adc",
    "bottom": "adc",
    "adc": "adc",
    "duo_carry": "adc",
    "carry": "adc",
    "support": "support",
    "supp": "support",
    "utility": "support",
    "duo_support": "support",
}
ROLE_ORDER = {"top": 0, "jungle": 1, "mid": 2, "adc": 3, "support": 4}
SLOT_ROLE_FALLBACK = {1: "top", 2: "jungle", 3: "mid", 4: "adc", 5: "support"}
UNUSABLE_ROLE_TEXT = ("", "none", "nan", "unknown")
UNKNOWN_ROLE = "unknown"

# --- fixed values: column groups used by cleaning ---------------------------
BINARY_COLUMNS = ("win", "is_blue_side", "firstblood", "firsttower", "firstinhib",
                  "firstbaron", "firstdragon", "firstharry")
NON_NEGATIVE_COLUMNS = ("kills", "deaths", "assists", "goldearned", "goldspent",
                        "totdmgtochamp", "totminionskilled", "neutralminionskilled")
# member-level columns never aggregated into side features
AGG_EXCLUDED = ("id", "matchid", "player", "teamid", "ss1", "ss2", "championid", "win")
# metadata columns never used as model features
RESERVED_FEATURES = ("matchid", "teamid", "gameid", "queueid", "seasonid", "creation", "duration")

# --- fixed values: feature definitions --------------------------------------
OBJECTIVE_COLUMNS = ("towerkills", "inhibkills", "dragonkills", "baronkills", "harrykills")
RELATIVE_FEATURES = ("kills_sum", "assists_sum", "deaths_sum", "goldearned_sum", "totdmgtochamp_sum",
                     "visionscore_sum", "towerkills", "dragonkills", "baronkills", "inhibkills")
ENCODER_CANDIDATES = ("championid", "championid_mode", "champion_1", "champion_2", "champion_3",
                      "champion_4", "champion_5", "top_championid", "jungle_championid",
                      "mid_championid", "adc_championid", "support_championid", "banned_champion_1",
                      "banned_champion_2", "banned_champion_3", "banned_champion_4", "banned_champion_5")
TE_SMOOTHING = 25.0
MAX_DRAFT_SLOTS = 5

# --- fixed values: leakage vocabulary ---------------------------------------
LEAK_EXACT = ("participant_win_consistency", "participant_win_inconsistent", "champion_signal_prior",
              "assists_sum_diff_vs_opp", "dragonkills_diff_vs_opp", "inhibkills_diff_vs_opp")
LEAK_SUBSTRINGS = ("participant_win", "turrent", "_winrate_te", "target_encoding", "label_encoding")
OUTCOME_PROXIES = ("firstblood", "firstbloodkill", "firsttower", "firstinhib", "firstbaron",
                   "firstdragon", "firstharry")

# --- fixed values: selection / scaling thresholds ---------------------------
CORRELATION_THRESHOLD = 0.98
VIF_THRESHOLD = 20.0
MIN_FEATURES_AFTER_VIF = 10
OUTLIER_IQR_FACTOR = 1.5
ROBUST_OUTLIER_SHARE = 0.05

# --- fixed values: audit ----------------------------------------------------
MIN_ACCURACY_DROP = 0.03
MIN_ROC_AUC_DROP = 0.005
