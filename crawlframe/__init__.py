"""Crawl-archive analytics as lazy PySpark DataFrame operators."""

from crawlframe.profile import SiteProfile

__all__ = ["SiteProfile"]
__version__ = "0.1.0"
