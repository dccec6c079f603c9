"""Review analytics on Spark: cleaning, star schema, reports and measures as DataFrame jobs."""

from reviewmill.plans.clean import clean_reviews
from reviewmill.plans.reports import REPORTS, require_all_reports, run_reports
from reviewmill.plans.star import Star, build_star
from reviewmill.session import build_session
from reviewmill.staging import Stage

__all__ = ["REPORTS", "Stage", "Star", "build_session", "build_star", "clean_reviews", "require_all_reports", "run_reports"]
