"""Reading source records; entity snapshots, progress ledger and reports."""
