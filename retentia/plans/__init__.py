"""The models: staging, core, signals, health, revenue, support and serving queries."""
