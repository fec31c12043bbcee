"""Everything that is specific to one crawled site.

Operators take a :class:`SiteProfile`; give it the name and the domain of the
site whose archive you query and all stored names, patterns and URLs follow.
"""

from __future__ import annotations

from dataclasses import dataclass

# The archive's own formats.  They must stay as they are.
USERNAME_CHARS = r"a-zA-Z0-9_\-~.`\[\]^"
VIEW_ID_PATTERN = "/view/([0-9]+)/"
DELETED_TEXT = "The submission you are trying to find is not in our database.                \nClick here to go back"
GDPR_BODY_ID = "pageid-error-account-unavailable-deleted"
FILE_SAFE_TIMESTAMP = "yyyy-MM-dd'T'HH_mm_ss.SSSSSS"
ARCHIVED_PAGE_NAME = "webpage_data.txt"
# Stored files are named with this unless a caller gives the stem of their archive.
ARCHIVE_STEM = "crawl_content"
# The selectors of the page elements that carry data.
SELECT_ARTIST = "div.submission-id-avatar > a"
SELECT_COMMENTER = "strong.comment_username > h3"
SELECT_ICON = "a.iconusername"
SELECT_LINK = "a.linkusername"
SELECT_AUTOLINK = "a.auto_link"
SELECT_FRONTPAGE = "#gallery-frontpage-submissions figure a[href]"
SELECT_SECTION = "div.section-body"
SELECT_GDPR = "body#pageid-error-account-unavailable-deleted"


@dataclass(frozen=True)
class SiteProfile:
    """Name and domain of a site; the rest is derived.

    ``site`` prefixes stored columns and WARC header keys
    (``<site>_submission_id``, ``<site>_scrape_attempt_id``); ``user_path`` and
    ``view_path`` are the path prefixes of user and item pages.
    """

    site: str = "gallery"
    domain: str = "gallery.example"
    user_path: str = "/user/"
    view_path: str = "/view/"

    # In these two patterns a dot matches any character, as stored links have
    # always been matched.
    @property
    def user_pattern(self) -> str:
        """Relative or absolute user link; the name is group 2."""
        origin = f"https?://(www.)?{self.domain}"
        return f"^(?:{origin})?{self.user_path}([{USERNAME_CHARS}]+)/?$"

    @property
    def main_page_pattern(self) -> str:
        return f"^https://www.{self.domain}{self.view_path}[0-9]+/"

    @property
    def accept_pattern(self) -> str:
        host = self.domain.replace(".", r"\.")
        theme = rf"www\.{host}/themes/beta"
        return "|".join(
            [
                rf"//[a,d]{{1}}\.{host}/.*",
                f"{theme}/css/.*",
                f"{theme}/img/banners/.*",
                f"{theme}/js/.*",
            ]
        )

    @property
    def submission_url_format(self) -> str:
        return f"https://www.{self.domain}{self.view_path}%d/"

    @property
    def attempt_id_header(self) -> str:
        return f"{self.site}_scrape_attempt_id"

    @property
    def submission_header(self) -> str:
        return f"{self.site}_submission"

    @property
    def stored_submission_id(self) -> str:
        """Column name of the site's own id in tables written by the crawler."""
        return f"{self.site}_submission_id"
