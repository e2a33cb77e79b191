from zonepulse.functions.temporal import (  # noqa: F401
    cyclic, day_of_week, demand_factor, is_overnight, is_rush_hour, is_weekend)
from zonepulse.functions.traffic import (  # noqa: F401
    congestion_level, congestion_ratio, delay_minutes, duration_minutes, occupancy_pct,
    speed_mph, trips_per_minute)
