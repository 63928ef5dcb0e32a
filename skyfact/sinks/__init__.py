"""Writers: star, warehouse, exports, report."""
