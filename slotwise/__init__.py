"""slotwise: booking and marketing-spend analytics on Spark."""

__version__ = "0.1.0"
