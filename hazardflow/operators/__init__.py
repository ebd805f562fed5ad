"""DataFrame operators: columns, quality, order statistics, points, reports, models."""
