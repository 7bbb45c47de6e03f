"""Parameters of the operators.

Values below marked FIXED must equal the behaviour being reproduced (channel
ids, action points, tier bounds, title deny lists).  Everything else is a
default that callers may override per call.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES -- channel ids
# ---------------------------------------------------------------------------
CHANNELS = {
    "film": 1969,
    "series": 1970,
    "variety": 1971,
    "animation": 1972,
    "kids": 1973,
    "documentary": 1974,
    "sport": 2263,
    "mv": 2264,
    "fitness": 2265,
    "education": 2271,
    "knowledge": 2272,
    "other": 0,
}
FILM, SERIES, VARIETY, KIDS = 1969, 1970, 1971, 1973

# ---------------------------------------------------------------------------
# FIXED VALUES -- action points and play tiers
# ---------------------------------------------------------------------------
POINTS_PLAY = (1, 2, 3, 4)          # <=6 min, short, middle, finished
POINTS_CLICK = 2
POINTS_TOP = 4
PLAY_SHORT_MIN = 6                  # minutes
PLAY_RATIO_BOUNDS = (0.3, 0.6)      # share of the item length
PLAY_MINUTE_BOUNDS = (30, 60)       # when the length is unknown or exceeded
PLAY_RANGE = (1, 200)               # kept when lo < minutes < hi (exclusive)
ITEM_LENGTH_BOUND = 200             # item length kept when < bound minutes
MISSING = -10                       # "no value" sentinel of play_time/total_num/movie_len
SCORE_PIVOT = 7
SCORE_MAX = 10

# ---------------------------------------------------------------------------
# Defaults (parameters)
# ---------------------------------------------------------------------------
VOCABULARY_SIZE = 5_400_000         # terms of the dictionary, most frequent first
KEYWORD_TOPK = 30
PROFILE_TOPK = 30
VECTOR_DIM = 100
W2V_MIN_COUNT = 3
W2V_PARTITIONS = 8                  # parts of the corpus that Word2Vec is trained on side by side
NEIGHBOURS_K = 100
CLUSTERS_K = 50
MIN_CLUSTER_SIZE = 800
SEED = 10
ANN_PROBES = 5
USER_PRE_TOPK = 1000
USER_FINAL_TOPK = 100
RECENT_DAYS = 7
HOT_DAYS = 30
HOT_RATIO_DAYS = 90
TEXTRANK_SPAN = 10
TEXTRANK_MIN_LEN = 2
TEXTRANK_DAMPING = 0.85
TEXTRANK_ITERATIONS = 10
VERSION_TITLE_MAX = 15              # titles kept when length < 15 (version filter)
KIDS_TITLE_MAX = 16                 # kids candidates dropped when length > 16
SOURCE_INTERNAL = 12
AUTH_TRAILER = 1
STATUS_ONLINE = 1
SLICE_EPOCH = (2020, 8, 10)         # first 10-day slice of the action logs
HOME_ZONE = "Asia/Shanghai"

# ---------------------------------------------------------------------------
# FIXED VALUES -- title rules (last two characters of a lower-cased title)
# ---------------------------------------------------------------------------
FILM_SUFFIX_DENY_CATALOG = ["像奖", "指南", "影节", "斯卡", "直击", "鲜看", "剧集", "音乐", "纪念", "电影", "体验", "看版"]
FILM_SUFFIX_DENY_RECALL = ["像奖", "指南", "影节", "斯卡", "直击", "鲜看", "剧集", "音乐", "纪念", "电影", "体验"]
SERIES_SUFFIX_DENY = ["映礼", "手记", "专访", "看版", "春晚", "老歌", "合集", "编版", "制版", "华版", "战队", "纪实",
                      "回顾", "剧场", "大赏", "og", "日常", "货版", "演唱", "p版", "录片", "盛典", "速看",
                      "mv", "外篇", "视频", "唱会"]
USER_SUFFIX_DENY = ["像奖", "指南", "影节", "斯卡", "直击", "鲜看"]
# first + fourth character
CHAR_PAIR_DENY = ["【】", "第届"]
BOOK_MARK = "《"
TEST_PREFIX = "test"
# whole titles dropped before the version filter, per channel
TITLE_DENY = {
    FILM: ["a2-b-c", "一、二、三,现在!", "一、二、三，现在！", "我们的存在（下）", "スターフィッシュホテル",
           "さいはてにてやさしい香りと待ちながら", "母の呗がきこえる", "&***()……%￥", "闘牌伝アカギ"],
    SERIES: ["2018星光盛典荣誉时刻"],
}


class Channels:
    """Which channel ids play the film / series / variety / kids roles.

    The rules of several operators depend on the channel role; the ids are
    parameters so the same operators run on catalogues with other channel
    keys (strings included)."""

    def __init__(self, film=FILM, series=SERIES, variety=VARIETY, kids=KIDS):
        self.film, self.series, self.variety, self.kids = film, series, variety, kids

    def role(self, cate_id):
        for name in ("film", "series", "variety", "kids"):
            if getattr(self, name) == cate_id:
                return name
        return "other"


DEFAULT_CHANNELS = Channels()
