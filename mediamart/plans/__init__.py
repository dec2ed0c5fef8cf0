"""The models: staging, core, marts, reporting, and the order in which they are built."""
