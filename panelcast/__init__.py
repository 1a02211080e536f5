"""panelcast: monthly demand panels, features, models and forecasts on Spark."""

__version__ = "0.1.0"
