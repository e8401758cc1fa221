"""Jobs: readings analytics, kernel forecast, warehouse questions, integrity audits, join helpers."""
