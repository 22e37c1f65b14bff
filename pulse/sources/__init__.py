"""Sources: driver tables, the derived status records, lexicons, replays."""
