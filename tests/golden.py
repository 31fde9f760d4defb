"""Published figures the builds must reproduce (fixed values)."""

# Trades per day, in date order from 2025-12-15; None marks a day without a row.
DAILY_TRADES = (
    8006, 5178, 7319, 6125, 5530, 0, 159, 4610, 3503, 1408,
    29, 0, None, None, 7669, 5523, 4288, 284, 9235, 0,
    395, 9119, 8676, 6597, 5317, 5406, 0, 120, 8988, 8131,
    8966, 6433, 4055, 0, 408, 2831, 6631, 7160, 5202, 5861,
    0, 482, 5683, 4894, 4492, 3997, 0, None, None, 10110,
    8580, 8049, 17520, 15732, 0, 535, 6813, 4760, 6632, 7243,
    6443, 0, 137, 2132, 5133, 5427, 4895, 5108, 0, 190,
    9380, 5872, 7675, 4854, 0, None, None, 12645, 8540, 11839,
    7065, 6340, 0, 681, 6800, 8129, 4916, 5346, 10195, 0,
    0, 5934, 5114, 7211,
)

DAILY_STATISTICS = {"n_days": 88, "total": 432_685, "mean": 4_916.875, "median": 5_259.5, "min": 0, "max": 17_520}

FIRST_WEEK, N_WEEKS = "2025-12-15", 20
