"""Warehouse layers: staging, dimensions, facts, marts, exports, reports, competitor job."""
