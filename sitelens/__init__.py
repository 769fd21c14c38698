"""sitelens: web-corpus fact extraction as Spark DataFrame jobs.

Tables of fetched pages go in; page text, links, section labels, ranked
link lists, crawl frontiers, merged per-site records and validation
reports come out.  Everything below is declared with the DataFrame/SQL
API so Catalyst plans it; Python runs only inside Arrow-batched helpers
where Spark has no built-in for the semantics.
"""

from sitelens.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
