"""Two small feeds, one per dialect, and their settings."""

SETTINGS = "﻿blog_publishing_mode,blog_name,blog_subdomain\nBLOGSPOT,\"Garden, and more\", gardennotes \nBLOGSPOT,Other,other\n"

TAKEOUT = """<?xml version='1.0' encoding='UTF-8'?>
<feed xmlns='http://www.w3.org/2005/Atom'>
  <id>tag:example,2020:blog-1</id>
  <title>Garden | Notes</title>
  <!-- the first one -->
  <entry>
    <id>p-1</id><type>POST</type><status>LIVE</status>
    <title>Tomatoes | and: "basil"</title>
    <content type='html'>&lt;h3&gt;Beds&lt;/h3&gt;&lt;p&gt;Two &lt;b&gt;raised&lt;/b&gt; beds.&lt;/p&gt;&lt;!-- x --&gt;</content>
    <created>2024-03-01T08:00:00.000Z</created>
    <published>2024-03-02T08:00:00Z</published>
    <updated>2024-03-05T08:00:00Z</updated>
    <category scheme='tag:example,2020:blog-1' term='soil'/>
    <category scheme='tag:example,2020:blog-1' term=' seeds '/>
    <category scheme='tag:example,2020:blog-1' term='soil'/>
    <category/>
    <filename>/2024/03/tomatoes.html</filename>
    <link/>
  </entry>
  <entry>
    <id>p-2</id><type>POST</type><status>LIVE</status><title>Tomatoes and basil</title>
    <content type='html'>&lt;p&gt;Same slug.&lt;/p&gt;</content>
    <published></published><created>2024-03-02T09:00:00Z</created>
    <filename>/2024/03/tomatoes-2.html</filename>
  </entry>
  <entry>
    <id>p-3</id><type>PAGE</type><status>DRAFT</status><title>Plan</title><content type='html'>x</content>
    <published>2024-01-01T00:00:00Z</published>
  </entry>
  <entry>
    <id>p-4</id><type>COMMENT</type><status>LIVE</status><title/><content type='html'>hi</content>
    <published>2024-01-01T00:00:00Z</published>
  </entry>
  <entry>
    <id>p-5</id><type>PAGE</type><status>TRASHED</status><title>Old</title><content type='html'>x</content>
    <trashed>2024-02-01T00:00:00Z</trashed>
  </entry>
  <entry>
    <id>p-6</id><type>POST</type><status>LIVE</status><title>Again</title><content type='html'>y</content>
    <published>2024-04-01T00:00:00Z</published><filename>/2024/03/tomatoes.html</filename>
  </entry>
  <entry>
    <id></id><type>Custom_Widget</type><status>LIVE</status><title> </title><content type='html'>z</content>
  </entry>
  <entry>
    <type>POST</type><status>LIVE</status><content type='html'></content><trashed>false</trashed>
  </entry>
</feed>
"""

LEGACY = """<?xml version='1.0' encoding='UTF-8'?>
<feed xmlns='http://www.w3.org/2005/Atom' xmlns:thr='http://purl.org/syndication/thread/1.0' xmlns:app='http://purl.org/atom/app#'>
  <title type='text'>Old blog</title>
  <link rel='alternate' type='text/html' href='https://old.example.com/'/>
  <author><name>Feed Author</name></author>
  <entry>
    <id>l-1</id><published>2020-01-01T00:00:00+08:00</published><updated/>
    <category scheme='http://schemas.google.com/g/2005#kind' term='http://schemas.google.com/blogger/2008/kind#post'/>
    <category scheme='http://www.blogger.com/atom/ns#' term='Été'/>
    <title type='text'>Straße &amp; Café</title>
    <content type='html'>&lt;table&gt;&lt;tr&gt;&lt;th colspan="2"&gt;A&lt;/th&gt;&lt;/tr&gt;&lt;/table&gt;</content>
    <link rel='self' type='application/atom+xml' href='https://old.example.com/self'/>
    <link rel='alternate' type='application/atom+xml' href='https://old.example.com/atom'/>
    <link rel='alternate' type='text/html' href='https://old.example.com/1.html' title='x'/>
    <author><name>Ann</name><email>a@example.com</email></author>
  </entry>
  <entry>
    <id>l-2</id><published>2020-01-02</published>
    <category scheme='http://schemas.google.com/g/2005#kind' term='http://schemas.google.com/blogger/2008/kind#post'/>
    <title type='text'>Draft</title><content type='html'>d</content>
    <app:control><app:draft>Yes</app:draft></app:control>
  </entry>
  <entry>
    <id>l-3</id><published>2020-01-03</published>
    <category scheme='http://schemas.google.com/g/2005#kind' term='http://schemas.google.com/blogger/2008/kind#post'/>
    <title type='text'>Re</title><content type='html'>c</content>
    <thr:in-reply-to ref='l-1'/>
  </entry>
  <entry>
    <id>l-4</id><published>2020-01-04</published>
    <category scheme='http://schemas.google.com/g/2005#kind' term='http://schemas.google.com/blogger/2008/kind#template'/>
    <title type='text'>T</title><content type='html'>t</content>
  </entry>
  <entry>
    <id>l-5</id><published>2020-01-05</published><title type='text'>Feed link only</title><content type='html'>f</content>
    <link rel='alternate' type='application/atom+xml' href='https://old.example.com/5.atom'/>
  </entry>
  <entry>
    <id>l-1</id><published>2020-01-06</published><title type='text'>Copy</title><content type='html'>f</content>
  </entry>
</feed>
"""
